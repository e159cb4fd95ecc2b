"""Verification of candidates: their own website, what its page proves, and the record made of that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import pages, text, urls
from loam.functions.binding import let
from loam.operators.discovery import fetch_error

VERIFIED = ("verified", "partially_verified")


def external_mode(candidates: DataFrame, mode: str = "all") -> DataFrame:
    """Candidates with an external address (with-external-url), without one (directory-only), or all."""
    has = F.coalesce(F.element_at("raw_metadata", "external_product_url") != "", F.lit(False))
    if mode not in ("all", "with-external-url", "directory-only"):
        raise ValueError(f"no such mode: {mode}")
    return candidates if mode == "all" else candidates.where(has if mode == "with-external-url" else ~has)


def first_rows(df: DataFrame, limit: int | None, order: str = "input_idx") -> DataFrame:
    """The first rows by order; all of them for 0 or none."""
    return df.orderBy(order).limit(limit) if limit else df


def outbound(html: Column) -> Column:
    """The first link of a directory's page that can be a product's own address."""
    own = F.transform(F.filter(F.transform(pages.hrefs(html), lambda h: F.trim(h)), lambda h: F.startswith(h, F.lit("http"))), urls.official_url)
    return F.get(F.filter(own, lambda u: u.isNotNull() & ~urls.is_disallowed(u)), F.lit(0))


def official_websites(candidates: DataFrame, directory: DataFrame) -> DataFrame:
    """Add official_website and resolve_errors: the external address found with the candidate, else the discovered one unless
    a directory's, else the first outbound link of the directory's page. directory: url, status_code, html, error."""
    given = F.element_at("raw_metadata", "external_product_url")
    external, found = urls.official_url(given), urls.official_url(F.col("discovered_url"))
    listed = directory.select(F.col("url").alias("dir_url"), F.col("status_code").alias("dir_status"), F.col("html").alias("dir_html"), F.col("error").alias("dir_error"))
    joined = candidates.join(listed, F.col("discovered_url") == F.col("dir_url"), "left")
    missing = F.coalesce(F.col("discovered_url"), F.lit("")) == ""
    error = fetch_error(F.col("dir_status"), F.col("dir_error"))
    unreadable = error.isNotNull() | (F.coalesce(F.col("dir_html"), F.lit("")) == "")
    linked = F.when(~unreadable, outbound(F.col("dir_html")))
    site = F.coalesce(external, found, linked)
    has = F.coalesce(given != "", F.lit(False))
    errors = F.array(
        F.when(has & external.isNull(), F.concat(F.lit("Discovered external URL was invalid or disallowed: "), given)),
        F.when(external.isNull() & missing, "No discovered URL or external product URL provided"),
        F.when(external.isNull() & ~missing & found.isNull() & unreadable, F.concat(F.lit("Directory listing unavailable: "), F.coalesce(error, F.lit("no content")))),
        F.when(site.isNull() & ~missing & ~unreadable, "No eligible official product website link found on directory page"),
    )
    return joined.withColumns({"official_website": site, "resolve_errors": F.array_compact(errors)}).drop("dir_url", "dir_status", "dir_html", "dir_error")


def _pieces(html: Column) -> Column:
    """The texts between the tags of a page's part, as they are read."""
    return F.transform(F.split(F.regexp_replace(html, "(?s)<[^>]*>", "\u0001"), "\u0001"), lambda x: F.regexp_replace(text.unescaped(x), r"(?U)^\s+|\s+$", ""))


def with_page_texts(df: DataFrame, html: str, prefix: str = "seen_") -> DataFrame:
    """Add a page without scripts, its title, headings, body and footer as texts. A column for each, as much is read from them."""
    readable = F.col(f"{prefix}readable")
    inside = lambda name: F.regexp_extract_all(readable, F.lit(rf"(?is)<{name}\b[^>]*>(.*?)</{name}>"), F.lit(1))
    joined = lambda part: F.array_join(_pieces(part), "")
    out = df.withColumn(f"{prefix}readable", F.regexp_replace(html, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1>|<!--.*?-->", ""))
    return out.withColumns(
        {
            f"{prefix}title": F.coalesce(joined(F.get(inside("title"), F.lit(0))), F.lit("")),
            f"{prefix}headings": F.array_join(F.transform(inside("h1"), lambda h: F.lower(joined(h))), " "),
            f"{prefix}body": F.array_join(F.filter(_pieces(readable), lambda x: x != ""), " "),
            f"{prefix}footer": F.coalesce(text.unescaped(F.regexp_replace(F.get(inside("footer"), F.lit(0)), "(?s)<[^>]*>", "")), F.lit("")),
        }
    )


def page_evidence(url: Column, tool_name: Column, prefix: str = "seen_") -> dict[str, Column]:
    """What a product's page says, by the name of the record's column; the page's texts are columns (see with_page_texts)."""
    readable, title, headings, body, footer = (F.col(f"{prefix}{c}") for c in ("readable", "title", "headings", "body", "footer"))
    said = pages.authenticity(tool_name, url, title, headings, body)
    return {
        "verification_status": said["verification_status"],
        "authenticity_error": said["error"],
        "page_description": F.coalesce(pages.meta(readable, "description", "name"), pages.meta(readable, "og:description")),
        "current_status": pages.status(title, body, readable),
        "inputs": pages.inputs(body),
        "outputs": pages.outputs(body),
        "supported_platforms": let(pages.platforms(body), lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.lit("Web")))),
        "integrations": pages.integrations(body),
        "api_availability": F.when(pages.offers_api(body), "True"),
        "open_source_status": pages.open_source(readable, body),
        **pages.pricing(body),
        "logo_url": pages.logo(readable, url),
        "footer_company": pages.copyright_owner(footer),
    }


def verify(candidates: DataFrame, fetched: DataFrame, as_of: Column) -> DataFrame:
    """Records of resolved candidates (see official_websites) by their fetched pages (url, status_code, html, error): columns
    of a product and of a stage. Without a website a candidate is unverified, without its page failed; neither has evidence.
    Texts stay whole but for the overview, which is the page's first 500 characters."""
    site = fetched.select(F.col("url").alias("site_url"), F.col("status_code").alias("site_status"), F.col("html").alias("site_html"), F.col("error").alias("site_error"))
    joined = candidates.join(site, F.col("official_website") == F.col("site_url"), "left")
    error = fetch_error(F.col("site_status"), F.col("site_error"))
    resolved = F.col("official_website").isNotNull()
    read = resolved & error.isNull() & (F.col("site_status") == 200) & (F.coalesce(F.col("site_html"), F.lit("")) != "")
    read = F.coalesce(read, F.lit(False))
    joined = joined.withColumn("page_html", F.when(read, F.col("site_html")))
    found = with_page_texts(joined, "page_html")
    found = found.withColumns({f"seen_{c}": e for c, e in page_evidence(F.col("official_website"), F.col("tool_name")).items()})
    seen = lambda c: F.when(read, F.col(f"seen_{c}"))
    empty = F.array().cast("array<string>")
    failed = F.concat(F.lit("Official website failed ("), F.col("official_website"), F.lit("): "), F.coalesce(error, F.concat(F.lit("HTTP "), F.col("site_status").cast("string")), F.lit("no content")))
    errors = F.concat("resolve_errors", F.array_compact(F.array(F.when(resolved & ~read, failed), seen("authenticity_error"))))
    short = F.coalesce(seen("page_description"), F.col("short_description"))
    made = {
        "candidate_id": F.coalesce("candidate_id", F.concat(F.lit("candidate-"), F.replace(text.entity_key(F.col("tool_name")), F.lit(" "), F.lit("-")))),
        "entity_type": F.lit("tool"),
        "verification_status": F.when(~resolved, "unverified").when(~read, "failed").otherwise(F.col("seen_verification_status")),
        "verification_errors": errors,
        "created_at": F.coalesce(F.col("discovery_timestamp").try_cast("timestamp"), as_of),
        "updated_at": as_of,
        "tool_name": F.coalesce(F.nullif("tool_name", F.lit("")), F.lit("Unnamed Tool")),
        "company_developer": F.coalesce(F.nullif("company_developer", F.lit("")), seen("footer_company")),
        "short_description": short,
        "detailed_overview": F.when(read, F.when(F.length("seen_body") > 100, F.substring("seen_body", 1, 500)).otherwise(short)),
        "primary_task": F.get("categories", F.lit(0)),
        **{c: F.col(c) for c in ("official_website", "categories", "tags", "discovery_source", "discovery_source_url", "discovery_references")},
        **{c: seen(c) for c in ("logo_url", "current_status", "api_availability", "open_source_status", "pricing_model", "starting_price", "free_plan", "free_trial")},
        **{c: F.coalesce(seen(c), empty) for c in ("inputs", "outputs", "supported_platforms", "integrations")},
        "last_verified_date": F.when(read, as_of),
        "verification_source": F.when(resolved, "Official Website"),
        "verification_source_url": F.col("official_website"),
    }
    made["record_id"] = made["candidate_id"]
    kinds = schemas.TOOL | schemas.STAGE
    made |= {c: (empty if k == "array<string>" else F.lit(None)).cast(k) for c, k in kinds.items() if c not in made}
    return found.select("input_idx", *[made[c].cast(k).alias(c) if not k.startswith("array<struct") else made[c].alias(c) for c, k in kinds.items()])


def verification_report(records: DataFrame) -> DataFrame:
    """One row: candidates by status, websites and logos resolved, and failed fetches."""
    status = F.col("verification_status")
    counts = {s: F.count_if(status == s).alias(s) for s in (*VERIFIED, "unverified", "failed")}
    return records.agg(
        F.count("*").alias("candidates_attempted"),
        *counts.values(),
        F.count_if(F.col("official_website").isNotNull()).alias("official_websites_resolved"),
        F.count_if(F.col("logo_url").isNotNull()).alias("logos_resolved"),
        F.count_if(F.exists("verification_errors", lambda e: F.startswith(e, F.lit("Official website failed")) | F.startswith(e, F.lit("Directory listing unavailable")))).alias("network_failures"),
    )


def verified_only(records: DataFrame) -> DataFrame:
    return records.where(F.col("verification_status").isin(*VERIFIED))
