"""Claims of work items: who claims one first has it, until it is done or given back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.urls import storage_url
from loam.operators.resolution import first_of


def keyed(df: DataFrame) -> DataFrame:
    """Add the compared source and address; rows without an address can't be claimed and go."""
    return df.withColumns({"source": F.trim("source"), "normalized_url": storage_url(F.col("url"))}).where("normalized_url != ''")


def claim(requests: DataFrame, held: DataFrame, order: str = "event_order") -> DataFrame:
    """The requests that win: of each item that isn't held the first, with its worker."""
    free = keyed(requests).join(held.select("source", "normalized_url"), ["source", "normalized_url"], "left_anti")
    won = first_of(free, ["source", "normalized_url"], [order])
    return won.select("source", "normalized_url", "worker_id", F.lit("CLAIMED").alias("status"), order)


def is_claimed(requests: DataFrame, held: DataFrame) -> DataFrame:
    """The requests whose item is held."""
    return keyed(requests).join(held.select("source", "normalized_url"), ["source", "normalized_url"], "left_semi")


def states(log: DataFrame, order: str = "event_order") -> DataFrame:
    """The latest state of every item by a log of CLAIM, COMPLETE, FAIL and RELEASE events: later claims of an item that is
    held change nothing, a release frees it."""
    w = Window.partitionBy("source", "normalized_url").orderBy(order)
    freed = F.coalesce(F.sum(F.when(F.col("event") == "RELEASE", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = keyed(log).withColumn("turn", freed)
    each = turns.groupBy("source", "normalized_url", "turn").agg(
        F.min_by("worker_id", F.when(F.col("event") == "CLAIM", F.col(order))).alias("worker_id"),
        F.max_by("event", order).alias("last"),
        F.max_by("event", F.when(F.col("event").isin("COMPLETE", "FAIL"), F.col(order))).alias("end"),
        F.count_if(F.col("event") == "CLAIM").alias("claims"),
    )
    latest = each.groupBy("source", "normalized_url").agg(F.max_by(F.struct("worker_id", "last", "end", "claims"), "turn").alias("s"))
    done = F.when(F.col("s.last") == "RELEASE", None).when(F.col("s.end") == "COMPLETE", "COMPLETED").when(F.col("s.end") == "FAIL", "FAILED").when(F.col("s.claims") > 0, "CLAIMED")
    return latest.select("source", "normalized_url", F.col("s.worker_id").alias("worker_id"), done.alias("status")).where("status is not null")
