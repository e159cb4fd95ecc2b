"""Chat formatting: every dialogue from the perspective of each of its speakers, native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.llm import common

#: Turns of a row. Only a dialogue of more turns comes as several rows, so that no task holds one of unbounded length;
#: begin tells where a row's text stands in the whole rendering, which the rows in order of block make up.
BLOCK_TURNS = 4_096
SYSTEM, UNKNOWN = "system", "?"
END = "<|end|>\n"
ASSISTANT = "<|assistant|>\n"


def speaker_name(role: Column) -> Column:
    """A role as it is shown: percent-encoded, so that different roles have different names; null is `?`."""
    coded = F.replace(F.replace(F.replace(F.url_encode(role), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("~"), F.lit("%7E"))
    return F.coalesce(coded, F.lit(UNKNOWN))


def _as_user(name: Column) -> Column:
    return F.when(name == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))


def _numbered(rows: DataFrame) -> DataFrame:
    """Add number, a turn's place in its dialogue from 0, without bringing a dialogue to one task: rows are dealt by ranges
    of (key, turn, name, said) and counted there; what a dialogue has in the ranges before is a small table."""
    order = ["nokey", "key", "noturn", "turn", "name", "said"]
    # turns that are alike in all of this are one row with a count, as they would all fall in one range
    alike = rows.withColumns({"nokey": F.col("key").isNull(), "noturn": F.col("turn").isNull()}).groupBy(*order).agg(F.count("*").alias("copies"))
    dealt = common.shared_table(alike.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "chat-turns")
    sums = dealt.groupBy("nokey", "key", "part").agg(F.sum("copies").alias("n"))
    of = Window.partitionBy("nokey", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # ranges of a dialogue are few: a dialogue's share of all rows, in ranges
    before = sums.select(F.col("nokey").alias("k0"), F.col("key").alias("k1"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(of), F.lit(0)).alias("before"))
    before = common.shared_table(before.where("before > 0"), "chat-before")
    here = Window.partitionBy("part", "nokey", "key").orderBy(*order[2:]).rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.withColumn("upto", F.coalesce(F.sum("copies").over(here), F.lit(0)))
    joined = counted.join(before, (F.col("part") == F.col("p")) & (F.col("nokey") == F.col("k0")) & F.col("key").eqNullSafe(F.col("k1")), "left")
    joined = joined.withColumn("first", F.col("upto") + F.coalesce("before", F.lit(0)))
    return joined.select("key", "name", "said", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias("number"))


def perspectives(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(key, speaker, block, begin, n_turns, rendered, spans): for every speaker of a dialogue, the dialogue with that
    speaker as the assistant and the others as named users; spans are the (start, end) of what the assistant says, ends of
    turns included, in characters of rendered: the mask of what is learned.

    Turns are ordered by number, those without one last, ties by speaker and text. System turns are kept as such and have
    no perspective; a dialogue of system turns only gives no row. Null roles are the speaker `?`, other names are
    percent-encoded; null texts are empty, and null keys one dialogue. Control marks within a text are broken up. Repeated
    rows are turns like any other; other columns aren't read. A dialogue is one row for each speaker; from block_turns
    turns on it is as many as needed, whose texts follow each other, with begin as the place of a row's first character.
    """
    said = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = _numbered(turns.select(F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"), speaker_name(F.col(role)).alias("name"), said.alias("said")))
    in_block = Window.partitionBy("key", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("block", F.floor(F.col("number") / block_turns).cast("long"))
    size = F.length(_as_user(F.col("name"))) + F.length("said") + F.lit(len(END))
    # where a turn begins if all speakers were users
    rows = rows.withColumn("size", size).withColumn("at", F.coalesce(F.sum("size").over(in_block), F.lit(0)).cast("int"))
    blocks = rows.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("number", "name", "said", "at"))).alias("turns"), F.sum("size").alias("chars"))
    blocks = common.shared_table(blocks, "chat-blocks")

    # slim rows: the speakers of a dialogue in each of its blocks, with what an own turn is shorter or longer by
    own = blocks.select("key", "block", "chars", F.explode(F.transform("turns", lambda t: t["name"])).alias("name"))
    counts = own.groupBy("key", "block", "chars", "name").agg(F.count("*").alias("own"))
    speakers = counts.where(F.col("name") != SYSTEM).select(F.col("key").alias("k"), F.col("name").alias("speaker")).distinct()
    views = blocks.select("key", "block", "chars").join(speakers, F.col("key").eqNullSafe(F.col("k"))).drop("k")
    mine = counts.select(F.col("key").alias("k"), F.col("block").alias("b"), F.col("name").alias("s"), "own")
    views = views.join(mine, F.col("key").eqNullSafe(F.col("k")) & (F.col("block") == F.col("b")) & (F.col("speaker") == F.col("s")), "left").drop("k", "b", "s")
    by_own = F.lit(len(ASSISTANT)) - F.length(_as_user(F.col("speaker")))
    earlier = Window.partitionBy("key", "speaker").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.col("chars") + F.coalesce("own", F.lit(0)) * by_own).over(earlier), F.lit(0))
    views = common.shared_table(views.select(F.col("key").alias("k"), F.col("block").alias("b"), "speaker", begin.cast("long").alias("begin")), "chat-views")

    seen = blocks.join(views, F.col("key").eqNullSafe(F.col("k")) & (F.col("block") == F.col("b")))
    head = lambda t: F.when(t["name"] == F.col("speaker"), F.lit(ASSISTANT)).otherwise(_as_user(t["name"]))
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["said"], F.lit(END))), "")
    start = lambda t, i: t["at"] + i * by_own + F.lit(len(ASSISTANT))
    spans = F.transform(
        F.filter("turns", lambda t: t["name"] == F.col("speaker")),
        lambda t, i: F.struct(start(t, i).alias("start"), (start(t, i) + F.length(t["said"]) + F.lit(len(END))).alias("end")),
    )
    return seen.select(F.col("key").alias(key), "speaker", "block", "begin", F.size("turns").cast("long").alias("n_turns"), rendered.alias("rendered"), spans.alias("spans"))


def op6_chat_views(spark, sf_dir: str) -> DataFrame:
    seen = perspectives(common.table(spark, sf_dir, "conversations"))
    return seen.withColumn("spans", F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ","))


OP6_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, replace(coalesce(text, ''), '<|', '< |') AS said,
    coalesce(replace(replace(url_encode(role), '*', '%2A'), '~', '%7E'), '?') AS name
  FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, name, said) - 1 AS number FROM rows),
blocks AS (SELECT *, number // {BLOCK_TURNS} AS block FROM numbered),
speakers AS (SELECT DISTINCT conv_id, name AS speaker FROM rows WHERE name != 'system'),
parts AS (
  SELECT b.conv_id, s.speaker, block, number, said || '<|end|>' || chr(10) AS body, name = s.speaker AS own,
    CASE WHEN name = 'system' THEN '<|system|>' WHEN name = s.speaker THEN '<|assistant|>' ELSE '<|user name=' || name || '|>' END || chr(10) AS head
  FROM blocks b JOIN speakers s ON b.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY number ROWS UNBOUNDED PRECEDING) AS upto FROM parts),
views AS (SELECT *, min(upto - length(head) - length(body)) OVER (PARTITION BY conv_id, speaker, block) AS begin FROM placed)
SELECT conv_id, speaker, block, CAST(any_value(begin) AS BIGINT) AS begin, count(*) AS n_turns, string_agg(head || body, '' ORDER BY number) AS rendered,
  coalesce(string_agg(CASE WHEN own THEN CAST(upto - begin - length(body) AS VARCHAR) || '-' || CAST(upto - begin AS VARCHAR) END, ',' ORDER BY number), '') AS spans
FROM views GROUP BY conv_id, speaker, block
"""
