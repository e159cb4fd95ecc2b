"""Queries that run a stream to its end; their SQL is that of the equivalent batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators.checkpoints import shared_dir
from loam.plans.queries import EVENTS_AS_OF, _requests, instant
from loam.streaming import claims


def finished(stream: DataFrame) -> DataFrame:
    """What a stream over the files that are there now gives, written to the shared folder."""
    spark = stream.sparkSession
    where = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/state")
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(claims.fresh(_events(spark, sf_dir), instant(EVENTS_AS_OF)).select("event_id"))


def stream_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _requests(spark, sf_dir, _events(spark, sf_dir)).withColumn("event", F.lit("CLAIM"))
    return finished(claims.claims(rows))


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the events that come together; how often one is remembered again depends on how files are dealt."""
    return finished(claims.first_seen(_events(spark, sf_dir), ["user_id"]).select("user_id"))


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/pages.parquet").schema
    return finished(claims.bounded(spark, f"{sf_dir}/page[s].parquet", schema).select("page_id"))


def stream_claim_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that are claimed, done or failed, and given back, in turn."""
    events = _events(spark, sf_dir).withColumn("user_id", F.col("event_id"))
    rows = _requests(spark, sf_dir, events.select("event_type", "user_id", "event_id"))
    log = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(e).alias("event")) for k, e in enumerate(("COMPLETE", "CLAIM", "CLAIM", "FAIL", "RELEASE", "RELEASE", "CLAIM"))])
    each = rows.withColumn("url", F.concat(F.lit("https://item.example/e"), "event_order")).select("source", "url", "worker_id", (F.col("event_order") * 10).alias("at"), F.explode(log).alias("x"))
    states = claims.claims(each.select("source", "url", "worker_id", (F.col("at") + F.col("x.k")).alias("event_order"), F.col("x.event").alias("event")))
    return finished(states).select("normalized_url", "status", (F.col("event_order") % 10).cast("int").alias("step"))


QUERIES = {"stream_fresh": stream_fresh, "stream_claims": stream_claims, "stream_first_seen": stream_first_seen, "stream_bounded": stream_bounded, "stream_claim_log": stream_claim_log}
SQL = {
    "stream_first_seen": "SELECT DISTINCT user_id FROM events",
    "stream_bounded": "SELECT page_id FROM pages",
    "stream_claim_log": "SELECT 'https://item.example/e' || event_id AS normalized_url, unnest(['CLAIMED', 'FAILED', 'FREE', 'CLAIMED']) AS status, unnest([1, 3, 4, 6]) AS step FROM events",
    "stream_fresh": f"SELECT event_id FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '{EVENTS_AS_OF}'",
    "stream_claims": """WITH c AS (SELECT event_type AS source, 'https://item.example/' || (user_id % 97) AS normalized_url, 'w' || (event_id % 7) AS worker_id, event_id AS event_order FROM events)
SELECT source, normalized_url, arg_min(worker_id, event_order) AS worker_id, 'CLAIMED' AS status, min(event_order) AS event_order FROM c GROUP BY 1, 2""",
}
