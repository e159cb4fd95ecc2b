"""Crawl results: status, browser fallback, links, metadata, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.functions import dates, pages, urls


def outcome(status_code: Column) -> Column:
    """What a response's status means for the crawl."""
    return (
        F.when(status_code.isNull(), "network_error")
        .when(status_code.isin(403, 429), "blocked")
        .when(status_code >= 500, "retry")
        .when(status_code >= 400, "failed")
        .otherwise("ok")
    )


def with_browser(plain: DataFrame, browser: DataFrame, key: str = "url") -> DataFrame:
    """One row for each row of `plain`: the browser's result where the plain page needs one and the browser succeeded. Results
    belong together by `key`; of several of the browser that succeeded the one of least status and html counts."""
    won = browser.where("success").groupBy(F.col(key).alias("__key")).agg(F.min(F.struct("status_code", "html", "success")).alias("__b"))
    joined = plain.join(won, F.col(key) == F.col("__key"), "left")
    use = F.col("__b").isNotNull() & (~F.coalesce(F.col("success"), F.lit(False)) | F.coalesce(pages.needs_browser(F.col("html")), F.lit(True)))
    picked = {c: F.when(use, F.col("__b").getField(c)).otherwise(F.col(c)) for c in ("status_code", "html", "success")}
    return joined.withColumn("used_browser", use).withColumns(picked).drop("__key", "__b")


# Job boards whose listings are made in the browser.
SCRIPTED_BOARDS = ("remoteok.com", "workingnomads.com", "jobspresso.co")


def lacks_postings(url: Column, html: Column) -> Column:
    """Whether a page of a board that is made in the browser came without its postings, so that it must be rendered."""
    host = urls.parts(url).host
    at = lambda site: F.contains(host, F.lit(site))
    jobs = F.regexp_extract_all(html, F.lit(r"/jobs/([a-zA-Z0-9_\-]+)"), F.lit(1))
    named = F.exists(jobs, lambda j: F.contains(j, F.lit("-")) & ~F.regexp_like(j, F.lit("^(?:bg-|remote-|static-)")))
    has = (at(SCRIPTED_BOARDS[0]) & F.regexp_like(html, F.lit(r"/remote-jobs/[a-zA-Z0-9_\-]+-\d+"))) | (at(SCRIPTED_BOARDS[1]) & named) | (at(SCRIPTED_BOARDS[2]) & F.regexp_like(html, F.lit(r"/job/[a-zA-Z0-9_\-]+/")))
    board = at(SCRIPTED_BOARDS[0]) | at(SCRIPTED_BOARDS[1]) | at(SCRIPTED_BOARDS[2])
    return F.coalesce((F.coalesce(url, F.lit("")) != "") & (F.coalesce(html, F.lit("")) != "") & board & ~has, F.lit(False))


def rate_limited(attempts: DataFrame, key: str = "url", attempt: str = "attempt") -> DataFrame:
    """What a client that waits once gets, by its first two attempts (status_code, retry_after, html): a 429 is tried again after
    retry_after seconds, 60 at most and by default; any other failure, or a second one, gives no html."""
    first, second = (attempts.where(F.col(attempt) == n).select(F.col(key), *[F.col(c).alias(f"{c}{n}") for c in ("status_code", "retry_after", "html")]) for n in (0, 1))
    joined = first.join(second, key, "left")
    limited = F.coalesce(F.col("status_code0") == 429, F.lit(False))
    ok = lambda n: F.coalesce(F.col(f"status_code{n}") == 200, F.lit(False))
    waited = F.when(limited, F.least(F.lit(60.0), F.coalesce(F.col("retry_after0").try_cast("double"), F.lit(60.0)))).otherwise(0.0)
    return joined.select(key, F.when(ok(0), F.col("html0")).when(limited & ok(1), F.col("html1")).alias("html"), waited.alias("waited"))


def crawl_summary(results: DataFrame) -> DataFrame:
    """One row: pages that were had and that weren't, and how many of them by browser."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    return results.agg(F.count("*").alias("urls"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.count_if(ok & F.col("used_browser")).alias("by_browser"))


def with_content(results: DataFrame) -> DataFrame:
    """Successful pages that have content, as every kind of record asks for."""
    return results.where(F.coalesce(F.col("success"), F.lit(False)) & (F.length(F.trim(F.coalesce("html", F.lit("")))) > 0))


def retry_delay(attempt: Column, base: float = 1.5, most: float = 60.0) -> Column:
    """Seconds before an attempt, from 0, without the random part."""
    return F.least(F.lit(most), F.pow(F.lit(base), attempt))


def news_link(source: Column, link: Column) -> Column:
    """Whether a link of a news listing is an article, by the listing's site."""
    s, path = F.lower(source), F.lower(urls.parts(link).path)
    segments = F.filter(F.split(urls.parts(link).path, "/"), lambda x: x != "")
    like = lambda p, c=link: F.regexp_like(c, F.lit(p))
    has = lambda c, x: F.contains(c, F.lit(x))
    return (
        F.when(has(s, "techcrunch.com"), like(r"techcrunch\.com/\d{4}/\d{2}/\d{2}/[^/]+/?$"))
        .when(has(s, "venturebeat.com"), has(link, "venturebeat.com") & (F.size(segments) >= 2) & ~F.get(segments, F.lit(0)).isin("category", "tag", "author", "page", "about", "events", "newsletters", "community"))
        .when(has(s, "technologyreview.com"), like(r"technologyreview\.com/(?:20\d\d/\d\d/\d\d/|\d{4}/\d{2}/\d{2}/\d+/[^/]+)"))
        .when(has(s, "wired.com"), has(link, "wired.com/story/"))
        .when(
            has(s, "engadget.com"),
            has(link, "engadget.com")
            & ~like("/category/|/about/|/tag/", path)
            & (like(r"engadget\.com/\d{7}/[^/]+/?$") | like(r"engadget\.com/[^/]+/[^/]+-\d+\.html$") | (has(path, "/ai/") & (F.size(segments) >= 2))),
        )
        .otherwise((F.size(segments) >= 2) & ~like("/category/|/tag/|/author/|/topic/", path))
    )


def job_link(source: Column, link: Column) -> Column:
    """Whether a link of a job board is a posting, by the board's site."""
    s, path = F.lower(source), F.lower(urls.parts(link).path)
    last = F.element_at(F.split(F.rtrim(link, F.lit("/")), "/"), -1)
    like = lambda p, c=link: F.regexp_like(c, F.lit(p))
    has = lambda c, x: F.contains(c, F.lit(x))
    return (
        F.when(has(s, "ycombinator.com"), has(link, "/companies/") & has(link, "/jobs/"))
        .when(has(s, "builtin.com"), has(link, "/job/") & like(r"/\d+$"))
        .when(has(s, "remoteok.com"), has(link, "/remote-jobs/") & ~like("^remote-jobs-in-|-jobs$|^remote-jobs$", last) & like(r"\d", last))
        .when(has(s, "workingnomads.com"), has(link, "/jobs/") & ~last.isin("jobs", "css", "assets", "fonts", "img") & ~like(r"(?:-jobs|\.css|\.js|\.png|\.svg|\.ico|\.woff2?)$", last))
        .when(has(s, "jobspresso.co"), has(link, "/job/") & ~like("(?:-jobs|-work)$|^jobs?$", last))
        .otherwise(like("/job/|/jobs/|/careers/", path) & (F.size(F.split(F.trim(path, F.lit("/")), "/")) >= 2))
    )


def candidate_links(listings: DataFrame, key: str, url: str = "url", html: str = "html", kind: Column | None = None, most: int = 10) -> DataFrame:
    """(key, position, link): the first `most` distinct item links of every listing, in document order.

    A page's links are told apart within its row, so that nothing is shuffled."""
    kind = F.lit("NEWS") if kind is None else F.upper(kind)
    absolute = F.transform(pages.hrefs(F.col(html)), lambda h: F.when(F.regexp_like(F.trim(h), F.lit(urls.ITEM_SKIP)), "").otherwise(urls.item_url(urls.join_simple(F.col(url), h))))
    blocked = "|".join(x.replace("-", "[-]") for x in urls.EXCLUDED_PATHS)
    wanted = F.filter(
        F.array_distinct(absolute),
        lambda u: (u != "") & (u != F.rtrim(F.col(url), F.lit("/"))) & ~F.regexp_like(F.lower(urls.parts(u).path), F.lit(blocked)) & F.when(kind == "JOB", job_link(F.col(url), u)).otherwise(news_link(F.col(url), u)),
    )
    return listings.select(key, F.posexplode(F.slice(wanted, 1, most)).alias("position", "link"))


def item_records(items: DataFrame, as_of: Column, kind: Column) -> DataFrame:
    """Add title, published, is_date_only and freshness to item pages (url, html); a date is never made up."""
    found = items.withColumn("__dates", pages.date_candidates(F.col("html"), kind))
    read = F.transform("__dates", lambda d: F.coalesce(dates.instant(d), dates.relative(d, as_of)))
    first = F.get(F.filter(F.arrays_zip(F.col("__dates").alias("raw"), read.alias("at")), lambda x: x["at"].isNotNull()), F.lit(0))
    out = found.withColumn("__first", first).withColumns({"title": pages.title(F.col("html")), "published": F.col("__first.at"), "is_date_only": dates.is_date_only(F.col("__first.raw"))})
    return out.withColumn("freshness", dates.freshness(F.col("published"), as_of)).drop("__dates", "__first")


def keep_crawled(results: DataFrame, as_of: Column, kind: str) -> DataFrame:
    """Successful pages with content; news and jobs only if their own date is fresh."""
    if kind.upper() not in ("NEWS", "JOB", "STARTUP", "PRODUCT"):
        raise ValueError(f"no such kind of record: {kind}")
    kept = with_content(results)
    if kind.upper() in ("NEWS", "JOB"):
        given = F.coalesce(*[dates.instant(F.col(c)) for c in ("published_date", "date", "published_at") if c in results.columns], F.lit(None).cast("timestamp"))
        kept = kept.where(dates.is_fresh(given, as_of))
    return kept.withColumns({"recordType": F.lit(kind.upper()), "collected_at": as_of})


def batches(df: DataFrame, order: str, size: int, by: Sequence[str] = ()) -> DataFrame:
    """Add batch, from 0, of `size` rows in order within a group; give groups, as one task orders each."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1) / size).cast("long"))


def pagination(counts: DataFrame, target: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows (batch, fetched, new) with `total`, the new ones so far, and `needed`: whether the batch would be fetched, as the
    ones before have neither reached the target, nor been empty, nor brought nothing new twice in a row."""
    order = Window.partitionBy(*by).orderBy("batch")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    barren = (F.col("new") == 0) & (F.lag("new").over(order) == 0)
    out = counts.withColumns({"total": F.sum("new").over(order), "__barren": F.coalesce(barren, F.lit(False))})
    stop = (F.coalesce(F.max("total").over(before), F.lit(0)) >= target) | F.coalesce(F.bool_or(F.col("fetched") == 0).over(before), F.lit(False)) | F.coalesce(F.bool_or("__barren").over(before), F.lit(False))
    return out.withColumn("needed", ~stop).drop("__barren")


def provider_cascade(df: DataFrame, keys: Sequence[str], priority: str, value: str) -> DataFrame:
    """The first answer that isn't null, in order of priority, and who gave it."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, priority).alias(value), F.min(priority).alias(priority))
