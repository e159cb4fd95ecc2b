"""Line dedup by site-relative frequency, native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm import common

BLANK = " \t\n\x0b\f\r"
#: A line on more of a host's pages is boilerplate. A page's own lines are on hardly any other page, and a site's lines on a
#: good part of them, so that the limit only has to lie between. At sf0.1 the planted line is on 8.7 % to 13.2 % of each
#: source's distinct pages, any other on 4.6 % at most.
MAX_RATIO = 0.065
#: Lines that reach the ratio are broadcast up to this many, joined by shuffle beyond.
MAX_BROADCAST_LINES = 200_000


def _keys(text: Column) -> Column:
    """Keys of a text's distinct lines that hold more than white space."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(BLANK))), lambda x: x != "")
    return F.array_distinct(F.transform(lines, lambda x: F.unhex(F.md5(x))))


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = 2) -> DataFrame:
    """(host, line, pages, total): keys of lines on over max_ratio of a host's pages, and on min_pages of them.

    Pages of a host with equal texts count as one page, so that exact copies, which other stages handle, don't turn a
    page's own lines into boilerplate. A line counts once a page. Only keys of lines are shuffled, counted per task first.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(F.col(host).alias("host"), F.md5(said).alias("page"), _keys(said).alias("lines"))
    pages = common.shared_table(slim.dropDuplicates(["host", "page"]), "lines-pages")
    totals = pages.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("total"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    return counts.join(totals, F.col("host").eqNullSafe(F.col("h"))).where(F.col("pages") > F.lit(max_ratio) * F.col("total")).select("host", "line", "pages", "total")


def dedup_lines(docs: DataFrame, text: str = "text", host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = 2, max_loss: float = 1.0) -> DataFrame:
    """docs without their hosts' boilerplate lines; adds n_lines and n_dropped.

    A line goes if it is on over max_ratio of its host's pages, and on min_pages of them at least, as a line of one page
    repeats nothing. Lines are parts of the text between newlines, compared without white space at their ends; blank lines
    stay. Null hosts are one host. Null texts stay null with 0 lines. A page of boilerplate alone becomes ''; with
    max_loss under 1, pages that would lose more than that share of their characters stay whole. Equal rows are treated
    alike. docs' own columns n_lines and n_dropped are replaced. Texts are not shuffled while the hosts' lists can be
    broadcast, which their count decides; beyond that the lists are a written table, so that Spark can split a hot host.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    found = common.shared_table(boilerplate(docs, text, host, max_ratio, min_pages), "lines-boilerplate")
    n = found.count()
    of, cut = (common.free_name(c, docs.columns) for c in ("cut_host", "cut_lines"))
    # a host's list is short: a page of k lines adds k to the sum of its lines' page counts, so at most mean(k) / max_ratio lines pass
    lists = common.shared_table(found.groupBy(F.col("host").alias(of)).agg(F.collect_list("line").alias(cut)), "lines-lists")
    joined = docs.select(*own).join(common.bounded_broadcast(lists, n, MAX_BROADCAST_LINES), F.col(host).eqNullSafe(F.col(of)), "left")
    lines = F.split(F.col(text), "\n", -1)
    left = F.filter(lines, lambda x: ~F.array_contains(F.col(cut), F.unhex(F.md5(F.trim(x, F.lit(BLANK))))))
    size = lambda xs: F.aggregate(xs, F.lit(0), lambda s, x: s + F.length(F.trim(x, F.lit(BLANK))))
    whole = F.col(cut).isNull()
    if max_loss < 1:
        whole |= size(left) < F.lit(1 - max_loss) * size(lines)
    kept = common.free_name("kept_lines", docs.columns)
    shaped = joined.withColumn(kept, F.when(whole, lines).otherwise(left))
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    return shaped.select(
        *[F.when(F.col(text).isNotNull(), F.array_join(kept, "\n")).alias(text) if c == text else F.col(c) for c in own],
        F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(F.col(text).isNull(), 0).otherwise(n_lines - F.size(kept)).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return dedup_lines(docs.select("doc_id", "source", "text")).select("doc_id", "n_lines", "n_dropped", "text")


OP2_SQL = """
WITH pages AS (SELECT DISTINCT source, coalesce(text, '') AS text FROM documents),
totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
lines AS (
  SELECT DISTINCT source, text, trim(line, E' \\t\\n\\x0b\\f\\r') AS line
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
counts AS (SELECT source, line, count(*) AS pages FROM lines WHERE line != '' GROUP BY source, line HAVING count(*) >= 2),
found AS (
  SELECT c.source, list(line) AS lines FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE pages > CAST(0.065 AS DOUBLE) * total GROUP BY c.source),
cut AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS was,
    list_filter(string_split(text, chr(10)), lambda x: NOT coalesce(list_contains(f.lines, trim(x, E' \\t\\n\\x0b\\f\\r')), false)) AS now
  FROM documents d LEFT JOIN found f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(was) END AS BIGINT) AS n_lines,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE len(was) - len(now) END AS BIGINT) AS n_dropped,
  CASE WHEN text IS NOT NULL THEN array_to_string(now, chr(10)) END AS text
FROM cut
"""
