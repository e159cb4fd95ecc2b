"""Deduplication of products by site, address and name, with merging of what the copies know."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import text, urls
from loam.operators.checkpoints import checkpointed

# Columns that a copy fills where the kept product has none.
FILLED = (
    "company_developer", "logo_url", "country", "version", "launch_date", "current_status", "primary_task", "pricing_model",
    "starting_price", "free_plan", "free_trial", "important_usage_limits", "api_availability", "open_source_status",
    "signup_requirement", "short_description", "detailed_overview", "ai_orbit_summary", "usage_adoption_signals",
)


def keys(tools: DataFrame) -> DataFrame:
    """Add __name, __dev, __domain (also a directory's), __site and __address (not of directories); '' for none."""
    host, address = urls.domain(F.coalesce(F.col("official_website"), F.lit(""))), urls.clean_url(F.col("official_website"))
    listed = F.regexp_like(address, F.lit("|".join(d.replace(".", "[.]") for d in urls.DIRECTORY_DOMAINS)))
    return tools.withColumns(
        {
            "__name": text.entity_key(F.col("tool_name")),
            "__dev": text.entity_key(F.col("company_developer")),
            "__domain": host,
            "__site": F.when(host.isin(*urls.DIRECTORY_DOMAINS), "").otherwise(host),
            "__address": F.when(listed, "").otherwise(address),
        }
    )


def labelled(keyed: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """(order, block) of the records that share a value of a column with others, directly or over others: these are in one
    block. '' is no value.

    Only such records can be merged, so that blocks can be worked on apart. Labels travel over the keys that records share:
    each round, every record takes the least label of those that share one of its keys, and its label's label. Records
    that share nothing, most of them, take part in no round.
    """
    pairs = keyed.select(order, F.explode(F.array(*[F.when(F.col(c) != "", F.concat(F.lit(f"{c}:"), F.col(c))) for c in columns])).alias("key")).where("key is not null")
    shared = pairs.groupBy("key").agg(F.count("*").alias("n"), F.min(order).alias("near")).where("n > 1")
    edges = checkpointed(pairs.join(shared.select("key", "near"), "key"))
    labels = checkpointed(edges.groupBy(order).agg(F.least(order, F.min("near")).alias("block")))
    while True:
        least = edges.select("key", order).join(labels, order).groupBy("key").agg(F.min("block").alias("near"))
        near = edges.select("key", order).join(least, "key").groupBy(order).agg(F.min("near").alias("near"))
        step = labels.join(near, order).select(order, F.col("block").alias("was"), F.least("block", "near").alias("now"))
        far = labels.select(F.col(order).alias("now"), F.col("block").alias("far"))
        after = checkpointed(step.join(far, "now").select(order, "was", F.least("now", "far").alias("block")))
        if after.where("was != block").isEmpty():
            return after.select(order, "block")
        labels = after.select(order, "block")


def _merge(kept: dict, copy: dict) -> None:
    """What a copy adds to the kept record: references, a verification, a better address, missing values, list items."""
    seen = {(r["source"], r["discovered_url"]) for r in kept["discovery_references"]}
    for r in copy["discovery_references"]:
        if (r["source"], r["discovered_url"]) not in seen:
            kept["discovery_references"].append(r)
            seen.add((r["source"], r["discovered_url"]))
    if (kept["verification_status"] or "").lower() != "verified" and (copy["verification_status"] or "").lower() == "verified":
        kept["verification_status"] = "verified"
        for c in ("official_website", "verification_source", "verification_source_url"):
            kept[c] = copy[c] or kept[c]
    own, other = kept["official_website"] or "", copy["official_website"] or ""
    if other and (not own or (len(other) < len(own) and "?" not in other)):
        kept["official_website"] = other
    for c in FILLED:
        if kept[c] is None:
            kept[c] = copy[c]
    for c in schemas.LISTS:
        kept[c] += [x for x in copy[c] if x and x not in kept[c]]


def _folded(block: list[dict], order: str) -> list[dict]:
    """The records of a block in order, each merged into the earlier one that it matches, if any. Kept records are found
    by the keys that they came with, except that a name leads to the last record kept under it; its own values, which
    merging may have filled, decide whether a name match is refused."""
    by_site: dict[str, dict] = {}
    by_address: dict[str, dict] = {}
    by_name: dict[str, dict] = {}
    out = []
    for r in sorted(block, key=lambda x: x[order]):
        match, why = by_site.get(r["__site"]) if r["__site"] else None, "domain"
        if match is None:
            match, why = by_address.get(r["__address"]) if r["__address"] else None, "product_url"
        if match is None and (named := by_name.get(r["__name"])):
            sites, devs = {r["__domain"], named["__domain"]} - {""}, {r["__dev"], named["__dev"]} - {""}
            if len(sites) < 2 and len(devs) < 2:
                match, why = named, "name_developer"
        if match is not None:
            before = match["company_developer"], match["official_website"]
            _merge(match, r)
            if match["company_developer"] != before[0]:
                match["__dev"] = r["__dev"]
            if match["official_website"] != before[1]:
                match["__domain"] = r["__domain"]
            match["__merged"][why] += 1
            continue
        r["__merged"] = {"domain": 0, "product_url": 0, "name_developer": 0}
        out.append(r)
        by_name[r["__name"]] = r
        if r["__site"]:
            by_site[r["__site"]] = r
        if r["__address"]:
            by_address[r["__address"]] = r
    return out


def merge_duplicates(tools: DataFrame, order: str = "input_idx") -> DataFrame:
    """One row for each product, the first by `order`, with what its copies add; domain_matches, url_matches and
    name_matches count those. Rows without a name go. Only blocks of two or more go through Python."""
    keyed = keys(tools).where("__name != ''")
    lists = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in schemas.LISTS} | {"discovery_references": F.coalesce(F.col("discovery_references"), F.array().cast(schemas.STAGE["discovery_references"]))}
    members = labelled(keyed, order, ["__site", "__address", "__name"]).withColumnRenamed("block", "__block")
    keyed = keyed.withColumns(lists)
    counts = ("domain_matches", "url_matches", "name_matches")
    alone = keyed.join(members, order, "left_anti").select(*tools.columns, *[F.lit(0).cast("long").alias(c) for c in counts])
    schema = alone.schema

    def plain(value):
        """A value as Python has it: arrays as lists, missing ones as None."""
        if isinstance(value, (list, dict)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
            return list(value) if not isinstance(value, dict) else value
        return None if value is None or pd.isna(value) else value

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [{c: plain(v) for c, v in r.items()} for r in pdf.to_dict("records")]
        out = _folded(rows, order)
        for r in out:
            r.update(zip(counts, r["__merged"].values(), strict=True))
        return pd.DataFrame(out, columns=schema.names)

    return alone.unionByName(keyed.join(members, order).groupBy("__block").applyInPandas(fold, schema))


def items_in_order(df: DataFrame, by: Sequence[str], column: str, order: str) -> DataFrame:
    """(by, column): the distinct items of a key's lists, in order of first appearance. Items are counted before they meet,
    so that a frequent key gathers its distinct items only; a key without items has no row."""
    items = df.select(*by, order, F.posexplode(column).alias("at", "item")).groupBy(*by, "item").agg(F.min(F.struct(order, "at")).alias("first"))
    return items.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("first", "item"))).alias("i")).select(*by, F.transform("i", lambda x: x["item"]).alias(column))


def ordered_union(df: DataFrame, by: Sequence[str], order: str, lists: Sequence[str], scalars: Sequence[str]) -> DataFrame:
    """Merge rows of a key without Python: the first value that isn't null of each scalar, and each list's distinct items in
    order of first appearance. For merges that don't depend on what was merged before."""
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in scalars]
    out = df.groupBy(*by).agg(*firsts, F.count("*").alias("merged"))
    for c in lists:
        out = out.join(items_in_order(df, by, c, order), list(by), "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return out.select(*by, *scalars, *lists, "merged")
