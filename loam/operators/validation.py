"""Gates that a product must pass, each with its error texts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import text, urls

# Hosts that may serve a product's logo, and the columns that each gate reads.
LOGO_HOSTS = ("googleusercontent.com", "githubusercontent.com", "amazonaws.com", "cloudfront.net", "wp.com", "cloudflare.com", "fastly.net", "cloudinary.com", "vercel.app", "supabase.co")
PLACEHOLDER_FIELDS = ("company_developer", "country", "version", "current_status", "primary_task", "pricing_model", "starting_price", "important_usage_limits")
CLEAN_FIELDS = PLACEHOLDER_FIELDS + ("ai_orbit_summary", "usage_adoption_signals", "record_id", "discovery_source", "verification_source", "short_description", "detailed_overview")


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)) == "", F.lit(True))


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c) == "", F.lit(True))


def _error(when: Column, *parts: str | Column) -> Column:
    return F.when(when, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def row_errors() -> Column:
    """Errors of a row that don't depend on other rows, as an array."""
    site = urls.parts(F.trim("official_website"))
    host = urls.domain(F.col("official_website"))
    status = F.lower(F.coalesce(F.col("verification_status"), F.lit("")))
    said = F.lower(F.concat_ws(" ", F.coalesce("short_description", F.lit("")), F.coalesce("detailed_overview", F.lit(""))))
    logo, logo_host = urls.parts(F.trim("logo_url")), urls.domain(F.col("logo_url"))
    cdn = F.regexp_like(logo_host, F.lit("(?:" + "|".join(map(re.escape, LOGO_HOSTS)) + ")$"))  # no dot needed before it
    single = [
        _error(_blank("tool_name"), "Identity: missing or empty tool_name"),
        _error(_blank("official_website"), "Identity: missing canonical official_website"),
        _error(~_blank("official_website") & ((site.scheme == "") | (site.host == "")), "Identity: invalid official_website URL '", F.trim("official_website"), "'"),
        _error(~status.isin("verified", "partially_verified"), "Verification: invalid verification_status '", status, "' (must be verified or partially_verified)"),
        _error(~_empty("official_website") & host.isin(*urls.VALIDATOR_DIRECTORIES), "Verification: directory URL cannot serve as official product website ('", host, "')"),
        _error(_blank("short_description"), "Description: missing short_description"),
        _error(_blank("detailed_overview"), "Description: missing detailed_overview"),
        *[_error(F.regexp_like(said, F.lit(rf"\b{re.escape(w)}\b")), f"Description Quality: contains marketing hype word '{w}'") for w in text.HYPE_WORDS],
        _error(_empty("pricing_model") & _empty("starting_price") & F.regexp_like(said, F.lit(r"\$\d+(?:\.\d+)?\s*(?:/|\bper\b)")), "Description Grounding: contains specific dollar pricing claim while pricing metadata is unverified/None"),
        *[_error(text.is_placeholder(F.col(c)), f"Null Correctness: field '{c}' contains placeholder value '", F.trim(c), "'") for c in PLACEHOLDER_FIELDS],
        _error(~_empty("logo_url") & ((logo.scheme == "") | (logo.host == "")), "Official Links: invalid logo_url '", F.trim("logo_url"), "'"),
        _error(~_empty("logo_url") & (logo.scheme != "") & (logo.host != "") & ~F.coalesce(urls.same_site(F.col("logo_url"), F.col("official_website")), F.lit(False)) & ~cdn, "Official Links: logo host '", logo_host, "' is neither official domain nor authorized CDN"),
        *[_error(text.is_forbidden(F.col(c)), f"Data Cleanliness: field '{c}' contains literal string '", F.col(c), "' instead of proper null") for c in CLEAN_FIELDS],
    ]
    def bad_items(c: str) -> Column:
        found = F.filter(c, lambda x: text.is_forbidden(x))
        return F.transform(found, lambda x: F.concat(F.lit(f"Data Cleanliness: list field '{c}' contains forbidden literal item '"), x, F.lit("'")))

    lists = [bad_items(c) for c in schemas.LISTS]
    empty = F.array().cast("array<string>")
    return F.concat(F.array_compact(F.array(*single)), *[F.coalesce(x, empty) for x in lists])


def validate(tools: DataFrame, order: str | Sequence[Column] = "input_idx") -> DataFrame:
    """Add errors, an array of texts; a row without errors passes. Of rows with one host, or one address, all but the
    first by `order` fail, whether or not that first one passes."""
    by = [F.col(order)] if isinstance(order, str) else list(order)
    host, address = urls.domain(F.col("official_website")), urls.validator_url(F.col("official_website"))
    out = tools.withColumns({"errors": row_errors(), "__host": host, "__address": address})
    later = lambda key: (F.row_number().over(Window.partitionBy(key).orderBy(*by)) > 1) & ~_empty("official_website")
    same_host = _error(later("__host"), "Duplicate: duplicate official domain '", F.col("__host"), "' detected across dataset")
    same_address = _error(later("__address"), "Duplicate: duplicate canonical product URL '", F.col("__address"), "' detected across dataset")
    return out.withColumn("errors", F.concat("errors", F.array_compact(F.array(same_host, same_address)))).drop("__host", "__address")


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed without errors, failed)."""
    return validated.where(F.size("errors") == 0).drop("errors"), validated.where(F.size("errors") > 0)


def error_counts(validated: DataFrame) -> DataFrame:
    """Errors by kind, the text before the first colon."""
    kinds = validated.select(F.explode("errors").alias("error")).select(F.substring_index("error", ":", 1).alias("kind"))
    return kinds.groupBy("kind").agg(F.count("*").alias("n"))
