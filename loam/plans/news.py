"""News and jobs: listings to fresh items, first of each address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import urls
from loam.operators import crawling, reporting, resolution


def fresh_items(listings: DataFrame, items: DataFrame, as_of: Column, kind: str, most: int = 10) -> DataFrame:
    """Items (url, html, source) that listings link to, with title, date and freshness; the first of each address.

    listings: source, position, url, html. The pages' HTML is dropped once it has been read."""
    links = crawling.candidate_links(listings.select("source", "url", "html"), "source", kind=F.lit(kind), most=most)
    pages = items.select(urls.item_url(F.col("url")).alias("link"), "html", "success")
    read = crawling.item_records(links.join(pages, "link"), as_of, F.lit(kind)).drop("html")
    return resolution.first_of(read, ["link"], ["source", "position"])


def summary(items: DataFrame) -> DataFrame:
    """Counts of items by source and freshness, and of all sources."""
    wanted = {n: F.col("freshness") == n for n in ("fresh", "stale", "future")} | {"missing": F.col("published").isNull(), "date_only": F.col("is_date_only")}
    return reporting.conditional_counts(items, ["source"], wanted, total=True)
