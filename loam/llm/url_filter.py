"""URL filter by rules and by a ratio of character language models, native."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.llm import common

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the models: digits are folded to 0, all else to *; ^ and $ stand for the ends.
ALPHABET = LOWER + "0./-?=_&#:%*^$"
#: Longest context in symbols. A context is used if the counted examples have it this often; else the next shorter one is.
DEPTH, MIN_CONTEXT = 5, 16
#: Weight of the shorter context in the smoothing of the longer one, as so many observations.
PRIOR = 2.0
#: One in FOLDS of the decided URLs, by hash, is not counted: the threshold is calibrated on those.
FOLDS = 5
#: Scores are sums of whole millionths, so that their order doesn't matter; thresholds are tried at this step.
UNIT, STEP = 1_000_000, 5_000
#: Sequences whose scores are broadcast, up to this many; beyond it the join is by shuffle.
MAX_BROADCAST = 1_000_000


def with_host_path(pages: DataFrame, url: str = "url", rest: str = "rest") -> DataFrame:
    """Add host and path, both empty for null or where there is no `://`, and the column `rest`, what follows it."""
    raw = common.free_name("raw_host", pages.columns, [rest])
    behind = F.coalesce(F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")), F.lit(""))
    out = pages.drop("host", "path").withColumn(rest, behind).withColumn(raw, F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr(f"substring({rest}, length({raw}) + 1)"), "^[^?#]*", 0)
    return out.withColumn("host", F.translate(raw, UPPER, LOWER)).withColumn("path", path).drop(raw)


def matched_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(f"/{path}"))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _grams(rest: Column) -> Column:
    """Every symbol of a URL, and its end, with the DEPTH symbols before it."""
    low = F.regexp_replace(F.regexp_replace(F.translate(rest, UPPER, LOWER), "[0-9]", "0"), r"[^a-z0./\-?=_&#:%]", "*")
    text = F.array(F.concat(F.lit("^" * DEPTH), low, F.lit("$")))
    return F.transform(text, lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - DEPTH), lambda i: F.substring(s, i, F.lit(DEPTH + 1))))[0]


def gram_scores(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, llr) of the grams asked for: ln P(symbol | context) of the accepted less that of the rejected, in whole UNITs,
    by counts (gram, a, r) of both. Each context that MIN_CONTEXT examples have is smoothed by the next shorter one; others
    leave the symbol to that. The counts of shorter sequences are sums, so that every level is an aggregate and a join."""
    k = len(ALPHABET)
    n = counts.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("r"), F.lit(0)).alias("r")).first()
    out = grams.select("gram")
    for size in range(DEPTH + 1):
        found = counts.groupBy(F.right("gram", F.lit(size + 1)).alias("own")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        own = F.right("gram", F.lit(size + 1))
        out = out.join(found, own == F.col("own"), "left").drop("own").fillna(0, ["a", "r"])
        if not size:
            out = out.select("gram", *[((F.col(c) + 1.0) / F.lit(float(n[c] + k))).alias(f"p{c}") for c in "ar"])
            continue
        context = F.substring("gram", DEPTH + 1 - size, size)
        of = counts.groupBy(context.alias("context")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr")).where(F.col("na") + F.col("nr") >= MIN_CONTEXT)
        out = out.join(of, context == F.col("context"), "left")
        p = [F.when(F.col("na").isNull(), F.col(f"p{c}")).otherwise((F.col(c) + PRIOR * F.col(f"p{c}")) / (F.col(f"n{c}") + PRIOR)).alias(f"p{c}") for c in "ar"]
        out = out.select("gram", *p)
    return out.select("gram", F.round((F.log("pa") - F.log("pr")) * UNIT).cast("long").alias("llr"))


def calibrated(scored: DataFrame) -> float:
    """The threshold of (label, n, norm) that splits accepted from rejected best: highest sum of both classes' shares on
    their own side, in the middle of the gap below the first score above it, then nearest to 0. 0 if a class is missing."""
    of = {c: F.sum(F.when(F.col("label") == says, F.col("n")).otherwise(0)).alias(c) for c, says in (("a", "allow"), ("r", "block"))}
    bins = scored.groupBy(F.floor(F.col("norm") / STEP).alias("bin")).agg(of["a"], of["r"])
    n = bins.agg(F.sum("a").alias("a"), F.sum("r").alias("r")).first()
    if not n.a or not n.r:
        return 0.0
    # at most some thousand bins, as symbols' scores are bounded
    order = Window.orderBy("bin")
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    right = F.lit(n.a) - F.coalesce(F.sum("a").over(below), F.lit(0)), F.coalesce(F.sum("r").over(below), F.lit(0))
    gain = right[0] / F.lit(float(n.a)) + right[1] / F.lit(float(n.r))
    at = (F.col("bin") + F.coalesce(F.lag("bin").over(order) + 1, F.col("bin"))) * (STEP / 2)
    best = bins.select(gain.alias("gain"), at.alias("at")).orderBy(F.desc("gain"), F.abs("at"), "at").first()
    return float(best["at"])


def filter_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Judge every URL; adds host, path, rule, verdict, score (mean log-likelihood difference of a symbol) and threshold.

    URLs that a rule decides are accepted and rejected examples: the models count four fifths of them, by hash, and the
    threshold is calibrated on the rest. URLs without a rule are allowed if their score reaches it. Null or malformed URLs
    have empty host and path and are scored as an empty text. Repeated rows are judged alike. Columns of the same names are
    replaced. Each distinct URL is scored once, by a join of its sequences with the models' table.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score", "threshold")]
    rest, label = common.free_name("rest", pages.columns), common.free_name("label", pages.columns)
    rule, verdict = matched_rule(rules)
    parsed = with_host_path(pages.select(*own), url, rest).withColumns({"rule": rule, label: verdict})
    urls = parsed.groupBy(F.col(rest).alias("rest")).agg(F.first(label).alias("label"), F.count("*").alias("n"))
    urls = common.shared_table(urls.withColumn("counted", F.col("label").isNotNull() & (F.conv(F.substring(F.md5("rest"), 1, 4), 16, 10).cast("long") % FOLDS != 0)), "url-distinct")
    grams = urls.select("rest", "label", "n", "counted", F.explode(_grams(F.col("rest"))).alias("gram"))
    of = {c: F.sum(F.when(F.col("counted") & (F.col("label") == says), F.col("n")).otherwise(0)).alias(c) for c, says in (("a", "allow"), ("r", "block"))}
    counts = common.shared_table(grams.groupBy("gram").agg(of["a"], of["r"]), "url-grams")
    scores = common.shared_table(gram_scores(counts.where("a + r > 0"), counts), "url-scores")
    scores = common.bounded_broadcast(scores, scores.count(), MAX_BROADCAST)
    norms = grams.join(scores, "gram").groupBy("rest", "label", "n", "counted").agg((F.sum("llr") / F.count("*")).alias("norm"))
    norms = common.shared_table(norms, "url-norms")
    threshold = calibrated(norms.where("label is not null and not counted").select("label", "n", "norm"))
    decided = F.when(F.col("norm") >= F.lit(threshold), F.lit("allow")).otherwise(F.lit("block"))
    judged = norms.select(F.col("rest").alias(f"{rest}_of"), decided.alias(f"{rest}_says"), (F.col("norm") / F.lit(float(UNIT))).alias("score"))
    joined = parsed.join(judged, F.col(rest) == F.col(f"{rest}_of"))
    return joined.select(*own, "host", "path", "rule", F.coalesce(label, f"{rest}_says").alias("verdict"), "score", F.lit(threshold / UNIT).alias("threshold"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(common.table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


_LONGEST_FIRST = sorted(RULES, key=lambda r: -len(r[0]))
_FITS = {rule: f"(host = '{rule.partition('/')[0]}' OR ends_with(host, '.{rule.partition('/')[0]}')) AND starts_with(path, '/{rule.partition('/')[2]}')" for rule, _ in RULES}

def _level_sql(k: int) -> str:
    """SQL for the probabilities by contexts of up to k symbols, l{k} from l{k-1}."""
    own, context = f"right(gram, {k + 1})", f"substr(gram, {DEPTH + 1 - k}, {k})"
    p = ", ".join(f"CASE WHEN x.na IS NULL THEN p{c} ELSE (coalesce(o.{c}, 0) + {PRIOR} * p{c}) / (x.n{c} + {PRIOR}) END AS p{c}" for c in "ar")
    return f"""o{k} AS (SELECT {own} AS own, sum(a) AS a, sum(r) AS r FROM c WHERE a + r > 0 GROUP BY 1),
x{k} AS (SELECT {context} AS context, sum(a) AS na, sum(r) AS nr FROM c GROUP BY 1 HAVING sum(a) + sum(r) >= {MIN_CONTEXT}),
l{k} AS (SELECT gram, {p} FROM l{k - 1} LEFT JOIN o{k} o ON {own} = o.own LEFT JOIN x{k} x ON {context} = x.context),
"""


OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
u AS (SELECT page_id, rest, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE {' '.join(f"WHEN {_FITS[x]} THEN '{x}'" for x, _ in _LONGEST_FIRST)} END AS rule FROM u),
l AS (SELECT *, CASE rule {' '.join(f"WHEN '{x}' THEN '{v}'" for x, v in RULES)} END AS label FROM r),
d AS (SELECT rest, any_value(label) AS label, count(*) AS n,
  '{"^" * DEPTH}' || regexp_replace(regexp_replace(translate(rest, '{UPPER}', '{LOWER}'), '[0-9]', '0', 'g'), '[^a-z0./\\-?=_&#:%]', '*', 'g') || '$' AS s FROM l GROUP BY rest),
f AS (SELECT *, label IS NOT NULL AND CAST('0x' || substr(md5(rest), 1, 4) AS BIGINT) % {FOLDS} <> 0 AS counted FROM d),
g AS (SELECT rest, label, n, counted, substr(s, CAST(i AS BIGINT), {DEPTH + 1}) AS gram FROM f, unnest(range(1, length(s) - {DEPTH - 1})) AS t(i)),
c AS (SELECT gram, sum(CASE WHEN counted AND label = 'allow' THEN n ELSE 0 END) AS a, sum(CASE WHEN counted AND label = 'block' THEN n ELSE 0 END) AS r FROM g GROUP BY gram),
o0 AS (SELECT right(gram, 1) AS own, sum(a) AS a, sum(r) AS r FROM c GROUP BY 1),
l0 AS (SELECT gram, {', '.join(f"(coalesce({x}0, 0) + 1.0) / CAST((SELECT coalesce(sum({x}), 0) FROM c) + {len(ALPHABET)} AS DOUBLE) AS p{x}" for x in 'ar')}
  FROM (SELECT gram, o.a AS a0, o.r AS r0 FROM c LEFT JOIN o0 o ON right(gram, 1) = o.own)),
{''.join(_level_sql(k) for k in range(1, DEPTH + 1))}m AS (SELECT gram, CAST(round((ln(pa) - ln(pr)) * {UNIT}) AS BIGINT) AS llr FROM l{DEPTH}),
s AS (SELECT rest, label, n, counted, sum(llr) / CAST(count(*) AS DOUBLE) AS norm FROM g JOIN m USING (gram) GROUP BY rest, label, n, counted),
b AS (SELECT floor(norm / {STEP}) AS bin, sum(CASE WHEN label = 'allow' THEN n ELSE 0 END) AS a, sum(CASE WHEN label = 'block' THEN n ELSE 0 END) AS r FROM s WHERE label IS NOT NULL AND NOT counted GROUP BY 1),
e AS (SELECT (sum(a) OVER () - coalesce(sum(a) OVER o, 0)) / CAST(sum(a) OVER () AS DOUBLE) + coalesce(sum(r) OVER o, 0) / CAST(sum(r) OVER () AS DOUBLE) AS gain,
  (bin + coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin)) * {STEP / 2} AS mid, sum(a) OVER () AS na, sum(r) OVER () AS nr
  FROM b WINDOW o AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT coalesce((SELECT mid FROM e WHERE na > 0 AND nr > 0 ORDER BY gain DESC, abs(mid), mid LIMIT 1), 0.0) AS threshold)
SELECT l.page_id, l.host, l.path, l.rule, coalesce(l.label, CASE WHEN s.norm >= (SELECT threshold FROM t) THEN 'allow' ELSE 'block' END) AS verdict FROM l JOIN s USING (rest)
"""
