"""Quality score of products, its tier and rationale, and ordered rejection reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import urls
from loam.functions.dates import age_days

# The most that each criterion gives, and the words that the criteria look for.
WEIGHTS = {"capability": 25.0, "usefulness": 20.0, "adoption": 15.0, "activity": 15.0, "maturity": 10.0, "recency": 5.0, "differentiation": 5.0, "information_quality": 5.0}
UTILITY_WORDS = (
    "developer", "coding", "productivity", "automation", "research", "data", "design", "writing", "agent", "prompt", "image",
    "audio", "video", "api", "assistant", "summary", "summarizer", "translation", "math", "ocr", "document",
)
SIGNAL_WORDS = ("stars", "users", "downloads", "customers", "ranked")
API_VALUES = ("true", "rest api", "graphql", "api available")
SHARED_HOSTS = ("vercel.app", "pages.dev", "github.io")
PRICING_VALUES = ("free", "freemium", "paid", "usage-based", "subscription")
DEAD = ("dead", "shut down", "deprecated", "inactive", "closed")
NO_PRODUCT_HOSTS = ("theresanaiforthat.com", "creati.ai", "producthunt.com")
TIERS = ((90.0, "Exceptional"), (80.0, "Excellent"), (70.0, "Good"), (60.0, "Average / Skip"))
# What the rationale says of a criterion that found nothing, and what it calls the criteria.
NOTHING = {"capability": "minimal", "usefulness": "unclear utility", "adoption": "no verified adoption proof", "maturity": "early/unstated", "recency": "no date evidence", "differentiation": "Standard utility"}
LABELS = {"capability": "Capability", "usefulness": "Usefulness", "adoption": "Adoption", "activity": "Activity", "maturity": "Maturity", "recency": "Recency", "differentiation": "Differentiation", "information_quality": "Info Quality"}


def _low(c: str) -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def _count(c: str) -> Column:
    return F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))


def _said(c: str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.col(c) != "", F.lit(False))


def _length(c: str) -> Column:
    return F.coalesce(F.length(F.trim(F.col(c))), F.lit(0))


def _points(*rules: tuple[Column, float]) -> Column:
    """The first rule's points that holds."""
    out = F.lit(0.0)
    for holds, points in reversed(rules):
        out = F.when(holds, F.lit(float(points))).otherwise(out)
    return out


def _some(text: Column, words) -> Column:
    return F.regexp_like(text, F.lit("|".join(words)))


def _sources() -> Column:
    """How many directories list a product."""
    named = F.coalesce(F.transform("discovery_references", lambda r: r["source"]), F.array().cast("array<string>"))
    return F.size(F.array_distinct(F.filter(named, lambda s: F.coalesce(s != "", F.lit(False)))))


def criteria(as_of: Column) -> dict[str, Column]:
    """Points by criterion, each up to its weight."""
    n = {c: _count(c) for c in ("inputs", "outputs", "supported_platforms", "ai_capabilities", "key_features", "main_use_cases", "categories")}
    up_to = lambda most, points: F.least(F.lit(float(most)), points.cast("double"))
    verified = _low("verification_status") == "verified"
    active = _low("current_status") == "active"
    status = F.trim(_low("current_status"))
    sources = _sources()
    useful_domain = _some(_low("primary_task"), UTILITY_WORDS) | F.coalesce(F.exists("categories", lambda c: _some(F.lower(c), UTILITY_WORDS)), F.lit(False))
    host = urls.parts(F.coalesce(F.col("official_website"), F.lit(""))).host
    age = age_days(F.col("launch_date"), as_of)
    found = {
        "capability": _points((_length("primary_task") > 2, 6)) + up_to(4, n["inputs"] * 2) + up_to(4, n["outputs"] * 2) + up_to(4, n["supported_platforms"] * 2) + up_to(4, n["ai_capabilities"] + n["key_features"]) + _points((_low("api_availability").isin(*API_VALUES), 3)),
        "usefulness": _points((useful_domain, 10), ((n["categories"] > 0) | _said("primary_task"), 6))
        + _points(((F.coalesce(F.length("detailed_overview"), F.lit(0)) > 60) & (F.coalesce(F.length("short_description"), F.lit(0)) > 20), 6), (_said("short_description"), 3))
        + F.when(n["main_use_cases"] > 0, up_to(4, n["main_use_cases"] * 2)).otherwise(_points(((n["inputs"] > 0) & (n["outputs"] > 0), 2))),
        "adoption": _points(((_length("usage_adoption_signals") > 5) & _some(_low("usage_adoption_signals"), SIGNAL_WORDS), 12), (_length("usage_adoption_signals") > 5, 6)) + _points((verified & active, 2)) + _points((sources >= 2, 3), (sources == 1, 1)),
        "activity": _points((status == "active", 15), (status == "beta", 10), (status == "pre-launch", 4), (status.isin("dead", "deprecated", "shut down", "inactive"), 0), (verified, 5), (F.lit(True), 1)),
        "maturity": _points((_length("company_developer") > 1, 4)) + _points(((host != "") & ~_some(host, [h.replace(".", "[.]") for h in SHARED_HOSTS]), 1)) + _points((_length("version") > 0, 2)) + _points((_low("pricing_model").isin(*PRICING_VALUES), 3)),
        "recency": _points((age <= 365, 5), (age <= 730, 4), (F.col("launch_date").isNotNull(), 2), (F.col("last_verified_date").isNotNull(), 3)),
        "information_quality": _points((verified & _said("official_website"), 2), (_said("official_website"), 1)) + _points((F.coalesce(F.startswith("logo_url", F.lit("http")), F.lit(False)), 1)) + _points((_said("pricing_model"), 1)) + _points((_said("short_description") & _said("detailed_overview"), 1)),
    }
    own = _points(((n["inputs"] >= 2) | (n["outputs"] >= 2), 2)) + _points((n["supported_platforms"] >= 2, 1.5)) + _points((_said("api_availability"), 1.5))
    found["differentiation"] = F.when(own == 0, F.lit(1.0)).otherwise(own)
    return {c: F.least(F.lit(w), found[c]) for c, w in WEIGHTS.items()}


def tier(score: Column) -> Column:
    out = F.lit("Reject")
    for least, name in reversed(TIERS):
        out = F.when(score >= least, F.lit(name)).otherwise(out)
    return out


def details(as_of: Column) -> dict[str, Column]:
    """What each criterion found, as the rationale has it in brackets."""
    n = {c: _count(c) for c in ("inputs", "outputs", "supported_platforms", "main_use_cases", "categories")}
    number = lambda c: c.cast("string")
    shown = lambda holds, *parts: F.when(holds, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    verified, status = _low("verification_status") == "verified", F.trim(_low("current_status"))
    useful = _some(_low("primary_task"), UTILITY_WORDS) | F.coalesce(F.exists("categories", lambda c: _some(F.lower(c), UTILITY_WORDS)), F.lit(False))
    signals, signal = _length("usage_adoption_signals") > 5, _some(_low("usage_adoption_signals"), SIGNAL_WORDS)
    sources = _sources()
    host = urls.parts(F.coalesce(F.col("official_website"), F.lit(""))).host
    age, year = age_days(F.col("launch_date"), as_of), F.year("launch_date").cast("string")
    found = {
        "capability": (
            shown(_length("primary_task") > 2, "Task: ", F.col("primary_task")),
            shown((n["inputs"] > 0) | (n["outputs"] > 0), "Modalities (", number(n["inputs"]), " in, ", number(n["outputs"]), " out)"),
            shown(n["supported_platforms"] > 0, "Platforms (", number(n["supported_platforms"]), ")"),
            shown(_low("api_availability").isin(*API_VALUES), "API verified"),
        ),
        "usefulness": (
            F.when(useful, "High workflow utility domain").when((n["categories"] > 0) | _said("primary_task"), "General utility domain"),
            shown((F.coalesce(F.length("detailed_overview"), F.lit(0)) > 60) & (F.coalesce(F.length("short_description"), F.lit(0)) > 20), "Documented problem solving"),
            shown(n["main_use_cases"] > 0, number(n["main_use_cases"]), " use cases"),
        ),
        "adoption": (
            F.when(signals & signal, F.concat(F.lit("Verified signals: "), "usage_adoption_signals")).when(signals, "Signals recorded"),
            shown(verified & (_low("current_status") == "active"), "Active live service"),
            shown(sources >= 2, "Multi-directory presence (", number(sources), " sources)"),
        ),
        "activity": (
            F.when(status == "active", "Active verified status")
            .when(status == "beta", "Beta release with active access")
            .when(status == "pre-launch", "Pre-launch status")
            .when(status.isin("dead", "deprecated", "shut down", "inactive"), F.concat(F.lit("Inactive status: "), status))
            .when(verified, "Verified live website (status unstated)")
            .otherwise("Unconfirmed operational status"),
        ),
        "maturity": (
            shown(_length("company_developer") > 1, "Developer: ", F.col("company_developer")),
            shown((host != "") & ~_some(host, [h.replace(".", "[.]") for h in SHARED_HOSTS]), "Dedicated domain"),
            shown(_length("version") > 0, "Version: ", F.col("version")),
            shown(_low("pricing_model").isin(*PRICING_VALUES), "Pricing: ", F.col("pricing_model")),
        ),
        "recency": (
            F.when(age <= 365, F.concat(F.lit("Launched within 1 year ("), year, F.lit(")")))
            .when(age <= 730, F.concat(F.lit("Launched within 2 years ("), year, F.lit(")")))
            .when(F.col("launch_date").isNotNull(), F.concat(F.lit("Established launch ("), year, F.lit(")")))
            .when(F.col("last_verified_date").isNotNull(), "Verified in current curation cycle"),
        ),
        "differentiation": (
            shown((n["inputs"] >= 2) | (n["outputs"] >= 2), "Multi-modal pipeline"),
            shown(n["supported_platforms"] >= 2, "Cross-platform support"),
            shown(_said("api_availability"), "Programmable API"),
        ),
        "information_quality": (
            shown(verified & _said("official_website"), "Official website verified"),
            shown(F.coalesce(F.startswith("logo_url", F.lit("http")), F.lit(False)), "Official logo verified"),
            shown(_said("pricing_model"), "Pricing model verified"),
            shown(_said("short_description") & _said("detailed_overview"), "Descriptions verified"),
        ),
    }
    joined = {c: F.array_join(F.array_compact(F.array(*parts)), ", ") for c, parts in found.items()}
    return {c: F.when(joined[c] == "", NOTHING[c]).otherwise(joined[c]) if c in NOTHING else joined[c] for c in WEIGHTS}


def one_decimal(x: Column) -> Column:
    return F.format_string("%.1f", x)


def score(tools: DataFrame, as_of: Column) -> DataFrame:
    """Add quality_score, quality_score_breakdown, quality_score_rationale and quality_tier. Missing columns' points are
    missing, never null: every row has a score from 0 to 100."""
    points = criteria(as_of)
    total = F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), sum(points.values(), F.lit(0.0)))), 1)
    out = tools.withColumn("quality_score_breakdown", F.create_map(*[x for c, p in points.items() for x in (F.lit(c), p)])).withColumn("quality_score", total)
    found = details(as_of)
    each = [F.concat(F.lit(f"{LABELS[c]}: "), one_decimal(F.col("quality_score_breakdown")[c]), F.lit(f"/{w:.0f} ("), found[c], F.lit(")")) for c, w in WEIGHTS.items()]
    rationale = F.concat(F.lit("Tier: "), tier(F.col("quality_score")), F.lit(" ("), one_decimal(F.col("quality_score")), F.lit("/100). "), F.concat_ws(" | ", *each))
    return out.withColumns({"quality_score_rationale": rationale, "quality_tier": tier(F.col("quality_score"))})


def rejection(reject_below: float = 60.0, qualify_at: float = 70.0) -> Column:
    """The first reason to reject a scored product; null to keep it."""
    status, verification = _low("current_status"), _low("verification_status")
    host = urls.parts(F.coalesce(F.col("official_website"), F.lit(""))).host
    justified = (
        _said("api_availability")
        | _said("open_source_status")
        | ((verification == "verified") & (status == "active") & _said("logo_url") & (_said("pricing_model") | F.col("free_plan").isNotNull()) & ((_count("inputs") > 0) | (_count("outputs") > 0)))
    )
    value = one_decimal(F.col("quality_score"))
    return (
        F.when(status.isin(*DEAD), F.concat(F.lit("Tool status is inactive/deprecated: '"), status, F.lit("'")))
        .when(verification.isin("unverified", "failed"), F.concat(F.lit("Verification failed or unverified: '"), verification, F.lit("'")))
        .when(_length("official_website") == 0, "Missing canonical official website")
        .when(_some(host, [h.replace(".", "[.]") for h in NO_PRODUCT_HOSTS]), "Directory URL cannot serve as official product website")
        .when(~_said("short_description"), "Missing short_description")
        .when(~_said("detailed_overview"), "Missing detailed_overview")
        .when(F.col("quality_score") < reject_below, F.concat(F.lit("Quality score "), value, F.lit(f" below threshold ({reject_below})")))
        .when((F.col("quality_score") >= 60) & (F.col("quality_score") < qualify_at) & ~justified, F.concat(F.lit("Score "), value, F.lit(" in 60-69 range without distinctive qualifying justification")))
    )


def split_rejected(scored: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    marked = scored.withColumn("rejection_reason", rejection(**options))
    return marked.where("rejection_reason is null").drop("rejection_reason"), marked.where("rejection_reason is not null")


def tier_distribution(scored: DataFrame) -> DataFrame:
    """Products by tier, with 0 for tiers that have none."""
    names = [n for _, n in TIERS] + ["Reject"]
    counts = scored.agg(*[F.count_if(F.col("quality_tier") == n).alias(n) for n in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("quality_tier"), F.col(f"`{n}`").alias("n")) for n in names])))
