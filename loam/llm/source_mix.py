"""Mixing sources to target weights by capped water-filling, native."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm import common

#: Sources are joined by broadcast up to this many, by shuffle beyond.
MAX_BROADCAST_SOURCES = 200_000
#: Rows of one source that are ordered together, about.
BUCKET_ROWS = 2_000


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, without bringing all of them to one task."""
    placed = common.shared_table(
        sources.withColumns({"__null": F.col("source").isNull()}).repartitionByRange("__null", "source").withColumn("__part", F.spark_partition_id()), "mix-sources"
    )
    before = {}
    total = 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("__part").count().collect()):
        before[part], total = total, total + n
    if not before:
        return placed.withColumn("rank", F.lit(0).cast("long")).drop("__null", "__part")
    offsets = placed.sparkSession.createDataFrame(list(before.items()), "__part int, __before long")
    order = Window.partitionBy("__part").orderBy("__null", "source")
    return placed.join(F.broadcast(offsets), "__part").withColumn("rank", F.col("__before") + F.row_number().over(order) - 1).drop("__part", "__before", "__null")


def water_fill(sources: DataFrame, weights: Sequence[int], budget: Decimal, max_epochs: int) -> DataFrame:
    """sources (source, source_size) with rank and target: shares of `budget` times all sizes by weight, none above
    max_epochs times its size; what is above is reshared by weight until none is. Each round is one aggregate."""
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = common.shared_table(_ranked(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs), "mix-ranked")
    level = None  # of water: target per unit of weight
    while True:
        capped = F.lit(False) if level is None else F.col("cap") <= F.col("weight") * F.lit(level)
        got = filled.agg(
            F.sum("source_size").alias("size"),
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if not got.size or not got.open:
            target = F.col("cap").cast("double")
            break
        new = (float(budget * got.size) - got.capped) / got.open
        if level is not None and new <= level:
            target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
            break
        level = new
    return filled.withColumn("target", target).drop("cap")


def mix_sources(
    docs: DataFrame, size: str, source: str = "source", key: str = "doc_id", weights: Sequence[int] = (5, 2, 1), budget: str = "1.5", max_epochs: int = 2, seed: str = "mix"
) -> DataFrame:
    """Add source_size, target, whole (repetitions of the whole row), part (words of a last, partial repetition) and taken.

    Each source takes round(target) words: every row floor(target / source_size) times, then rows in the order of
    md5(seed, key) once more until the words are reached; the row at the edge gives only the words still missing.
    So sums are exact, no row gives over max_epochs times its size, and reruns agree. Null sources are one source,
    the last; null keys are ordered by a hash of their size. Equal rows tie and are interchangeable. Rows of size 0 take 0.
    Columns of docs named like one of the added ones are replaced.

    The rows of a source are never ordered in one task: they fall in buckets by hash, sums of buckets tell which
    bucket holds the edge, and only that bucket is ordered.
    """
    own = [c for c in docs.columns if c not in ("source_size", "target", "whole", "part", "taken")]
    name = {c: common.free_name(c, docs.columns) for c in ("of", "size_", "hash", "s", "extra", "buckets", "bucket", "es", "edge", "before")}
    col = {k: F.col(c) for k, c in name.items()}
    n_words = F.coalesce(F.col(size).cast("long"), F.lit(0))
    said = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("#"), n_words.cast("string")))
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), said)), 1, 12), 16, 10).cast("long")
    rows = docs.select(*own, F.col(source).alias(name["of"]), n_words.alias(name["size_"]), hashed.alias(name["hash"]))
    sums = common.shared_table(rows.groupBy(col["of"].alias("source")).agg(F.sum(col["size_"]).alias("source_size"), F.count("*").alias("rows")), "mix-sums")
    n_sources = sums.count()
    quota = F.round("target").cast("long")
    plan = water_fill(sums, weights, Decimal(budget), max_epochs).select(
        F.col("source").alias(name["s"]),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.expr("cast(round(target) as long) div source_size")).otherwise(0).cast("long").alias("whole"),
        F.when(F.col("source_size") > 0, quota % F.col("source_size")).otherwise(0).alias(name["extra"]),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS)).alias(name["buckets"]),
    )
    plan = common.shared_table(plan, "mix-plan")
    small = common.bounded_broadcast(plan, n_sources, MAX_BROADCAST_SOURCES)
    bucket = F.floor(col["hash"] / F.lit(281474976710656.0) * col["buckets"]).cast("long")
    joined = rows.join(small, col["of"].eqNullSafe(col["s"])).withColumn(name["bucket"], bucket)
    in_bucket = joined.groupBy(col["s"], col["bucket"], col["extra"]).agg(F.sum(col["size_"]).alias("n"))
    # the buckets of a source are few: its rows / BUCKET_ROWS; their running sums tell where the edge lies
    running = in_bucket.withColumn("upto", F.sum("n").over(Window.partitionBy(col["s"]).orderBy(col["bucket"]))).where(F.col("upto") > col["extra"])
    edges = running.groupBy(col["s"]).agg(F.min(F.struct(col["bucket"].alias("b"), (F.col("upto") - F.col("n")).alias("before"))).alias("e"))
    edges = common.shared_table(edges.select(col["s"].alias(name["es"]), F.col("e.b").alias(name["edge"]), F.col("e.before").alias(name["before"])), "mix-edges")
    joined = joined.join(common.bounded_broadcast(edges, n_sources, MAX_BROADCAST_SOURCES), col["s"].eqNullSafe(col["es"]), "left")
    at_edge = F.coalesce(col["bucket"] == col["edge"], F.lit(False))
    before_edge = col["edge"].isNull() | (col["bucket"] < col["edge"])
    settled = joined.where(~at_edge).withColumn("part", F.when(before_edge, F.least(col["size_"], col["extra"])).otherwise(0))
    order = Window.partitionBy(col["s"]).orderBy(col["hash"], F.col(key).asc_nulls_first(), col["size_"]).rowsBetween(Window.unboundedPreceding, -1)
    upto = col["before"] + F.coalesce(F.sum(col["size_"]).over(order), F.lit(0))
    split = joined.where(at_edge).withColumn("part", F.greatest(F.lit(0), F.least(col["size_"], col["extra"] - upto)))
    taken = F.col("whole") * col["size_"] + F.col("part")
    return settled.unionByName(split).select(*own, "source_size", "target", "whole", F.col("part").cast("long").alias("part"), taken.cast("long").alias("taken"))


def repetitions(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The rows that the mix has: each row `whole` times, then once more, cut after its word number `part`, if part > 0."""
    own = [c for c in mixed.columns if c not in ("source_size", "target", "whole", "part", "taken")]
    starts = F.split(F.regexp_replace(F.col(text), f"^[{common.SPACE}]+", ""), f"(?<=[{common.SPACE}])(?=[^{common.SPACE}])")
    cut = F.array_join(F.slice(starts, F.lit(1), F.col("part").cast("int")), "")
    n = common.free_name("turn", mixed.columns)
    rows = mixed.withColumn(n, F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))).where((F.col(n) < F.col("whole")) | (F.col("part") > 0))
    return rows.withColumn(text, F.when((F.col(n) < F.col("whole")) | (F.col("part") >= F.col("size")), F.col(text)).otherwise(cut)).select(*own)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    sized = docs.withColumn("size", F.size(common.words(F.col("text"))).cast("long"))
    return mix_sources(sized, "size", **options)


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = common.shared_table(docs.select("doc_id", "source", F.size(common.words(F.col("text"))).cast("long").alias("size")), "mix-sized")
    return mix_sources(sized, "size").select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS r FROM sums),
weighed AS (SELECT source, source_size, 2 * source_size AS cap, CASE r WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM ranked),
filling AS (
  SELECT *, CAST(sum(source_size) OVER () * 1.5 AS DOUBLE) AS budget, sum(weight) OVER () AS all_weight,
         coalesce(CAST(sum(cap) OVER below AS DOUBLE), 0) AS cap_below, coalesce(sum(weight) OVER below, 0) AS weight_below
  FROM weighed WINDOW below AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max((budget - cap_below) / (all_weight - weight_below)) AS water FROM filling
  WHERE (budget - cap_below) / (all_weight - weight_below) * weight < cap),
plan AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce(weight * water, CAST(cap AS DOUBLE))) AS target FROM weighed, level),
rows AS (
  SELECT s.*, p.source_size, p.target, CAST(round(p.target) AS BIGINT) AS quota,
         coalesce(sum(size) OVER (PARTITION BY s.source
           ORDER BY substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '#' || size)), 1, 12), doc_id NULLS FIRST, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (quota // source_size) * size + greatest(0, least(size, quota % source_size - before)) END AS BIGINT) AS taken
FROM rows
"""
