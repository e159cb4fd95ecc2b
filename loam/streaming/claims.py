"""Claims and freshness on streams."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loam.functions import dates
from loam.operators.claims import keyed

#: Buckets that items are dealt to, each with one state.
BUCKETS = 1 << 12
WINNERS = "source string, normalized_url string, worker_id string, status string, event_order long"


def claims(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Changes of state of a stream of CLAIM, COMPLETE, FAIL and RELEASE events (source, url, worker_id, event, event_order).

    One task has the state of an item, so that of claims that come together the one of lowest order wins; a claim of an
    item that is held changes nothing; a release frees it. Items are dealt to buckets by hash, whose events and state are
    handled together: a call of Python for each item would take far longer than the item. A batch rewrites what is held in
    the buckets that it has events of."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {(s, u): (w, now) for s, u, w, now in json.loads(state.get[0])} if state.exists else {}
        rows = pd.concat(list(batches)).sort_values("event_order", kind="stable")
        out = []
        for source, url, worker, event, order in zip(*(rows[c].tolist() for c in ("source", "normalized_url", "worker_id", "event", "event_order")), strict=True):
            item = (source, url)
            had = held.get(item)
            if event == "CLAIM" and had is None:
                now = held[item] = (worker, "CLAIMED")
            elif event in ("COMPLETE", "FAIL") and had is not None:
                now = held[item] = (had[0], "COMPLETED" if event == "COMPLETE" else "FAILED")
            elif event == "RELEASE" and had is not None:
                del held[item]
                now = (None, "FREE")
            else:
                continue
            out.append((*item, *now, int(order)))
        if held:
            state.update((json.dumps([(*item, *now) for item, now in held.items()]),))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[f.split()[0] for f in WINNERS.split(", ")])

    bucket = F.pmod(F.xxhash64("source", "normalized_url"), F.lit(buckets)).cast("int")
    rows = keyed(events).select(bucket.alias("bucket"), "source", "normalized_url", "worker_id", "event", "event_order")
    return rows.groupBy("bucket").applyInPandasWithState(step, WINNERS, "held string", "append", GroupStateTimeout.NoTimeout)


def fresh(events: DataFrame, as_of, ts: str = "ts", delay: str = "24 hours") -> DataFrame:
    """Fresh events only. The watermark lets old state go; which events are fresh is decided by the instant given."""
    return events.withWatermark(ts, delay).where(dates.is_fresh(F.col(ts), as_of))


def first_seen(events: DataFrame, keys: list[str], ts: str = "ts", within: str = "24 hours") -> DataFrame:
    """The first event of each key, remembered for a bounded time."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def bounded(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """A stream of Parquet files that takes so many at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
