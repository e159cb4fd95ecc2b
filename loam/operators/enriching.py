"""Descriptions by a language model: the texts it is asked with, and what becomes of its answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import text
from loam.operators.verifying import VERIFIED

# The formats that the model is asked for, by kind of record, and the rules it is given.
FORMATS = {
    "STARTUP": '{\n  "entityName": "string (name of startup or company)",\n  "employeeCount": "integer or null (total number of employees, null if unknown)"\n}',
    "PRODUCT": '{\n  "startupName": "string (name of company offering the product)",\n  "pricingModel": "string (strictly one of: \'FREE\', \'FREEMIUM\', \'PAID\', \'ENTERPRISE\', or null)"\n}',
    "RESEARCH_PAPER": '{\n  "title": "string (paper title)",\n  "authors": ["list of author name strings"],\n  "paper_url": "string or null (URL of paper if stated, else null)",\n  "github_url": "string or null (official repository link ONLY if explicitly stated)",\n  "github_stars": "integer or null (star count ONLY if explicitly stated)",\n  "published_date": "string or null (ISO-8601 date, e.g. \'YYYY-MM-DD\')"\n}',
    "JOB": '{\n  "company": "string (hiring company name)",\n  "date": "string or null (posting or recorded date, ISO-8601 format)",\n  "is_remote": "boolean (true if remote/work-from-home, false otherwise)",\n  "role_family": "string (job function or domain, e.g. \'Engineering\', \'Research\')"\n}',
    "NEWS": '{\n  "title": "string (news headline or article title)",\n  "text": "string (summary or main body of the article)",\n  "published_date": "string or null (ISO-8601 date, e.g. \'YYYY-MM-DD\')"\n}',
    "AI_TOOL_DESCRIPTION": '{\n  "short_description": "string (1-2 concise, factual sentences explaining what the tool does and its primary use case without marketing hype)",\n  "detailed_overview": "string (2-5 concise, factual sentences covering verified task, capabilities, inputs/outputs, and pricing only if verified)"\n}',
}
OTHER_FORMAT = '{\n  "name": "string or null",\n  "description": "string or null"\n}'
SYSTEM_HEAD = "You are an expert, deterministic information extraction system.\nExtract structured data from the source text into valid JSON for record type: "
SYSTEM_RULES = (
    ".\n\nSTRICT ANTI-HALLUCINATION RULES:\n"
    "1. Extract ONLY information explicitly stated in and directly supported by the source text.\n"
    "2. DO NOT hallucinate, guess, infer, or fabricate any facts or metadata.\n"
    "3. Never invent company names, entity names, URLs, dates, employee counts, GitHub repositories, or numbers.\n"
    "4. If any field or detail is not explicitly mentioned in the text, set that field to null (or [] for empty lists).\n"
    "5. Source URLs and GitHub links must never be fabricated; only extract them if they appear verbatim in the text.\n"
    "6. Return ONLY a single valid, parseable JSON object. Do not include introductory text, conversational remarks, or markdown prose outside the JSON."
)
OVERVIEW_CHARS = 1500


def prompts(source: Column, kind: Column) -> tuple[Column, Column]:
    """What a model is told, and asked, to extract a record of a kind from a text."""
    at = F.upper(F.trim(kind))
    wanted = F.lit(OTHER_FORMAT)
    for name, shape in FORMATS.items():
        wanted = F.when(at == name, F.lit(shape)).otherwise(wanted)
    system = F.concat(F.lit(SYSTEM_HEAD), kind, F.lit(SYSTEM_RULES))
    parts = (F.lit("Record Type: "), kind, F.lit("\n\nExpected JSON Schema:\n"), wanted, F.lit("\n\nSource Text:\n---\n"), source, F.lit("\n---\n\nExtract the JSON matching the schema above. Return only the JSON object."))
    return system, F.concat(*parts)


def evidence() -> Column:
    """What is known of a product, line by line; what isn't is said not to be."""
    said = lambda c, other: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(other))
    listed = lambda c, other: F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.array_join(c, ", ")).otherwise(other)
    stated = lambda c: F.when(F.col(c), "Yes").when(~F.col(c), "No").otherwise("Not verified")
    overview = F.coalesce(F.nullif("detailed_overview", F.lit("")), F.nullif("short_description", F.lit("")), F.lit("No further page evidence"))
    lines = (
        ("Tool Name: ", F.coalesce("tool_name", F.lit("Unknown Tool"))),
        ("Primary Task: ", said("primary_task", "Not verified")),
        ("Categories: ", listed("categories", "None")),
        ("Verified Inputs: ", listed("inputs", "None verified")),
        ("Verified Outputs: ", listed("outputs", "None verified")),
        ("Verified Pricing Model: ", said("pricing_model", "Not publicly verified")),
        ("Verified Starting Price: ", said("starting_price", "Not publicly verified")),
        ("Verified Free Plan: ", stated("free_plan")),
        ("Verified Free Trial: ", stated("free_trial")),
        ("Supported Platforms: ", listed("supported_platforms", "None verified")),
        ("Verified Integrations: ", listed("integrations", "None verified")),
        ("API Available: ", F.when(F.col("api_availability") == "True", "Yes").otherwise("Not verified")),
        ("Open Source: ", said("open_source_status", "Not verified")),
        ("", F.lit("Official Page Context / Evidence:")),
        ("", F.when(F.length(overview) > OVERVIEW_CHARS, F.concat(F.substring(overview, 1, OVERVIEW_CHARS), F.lit("..."))).otherwise(overview)),
    )
    return F.concat_ws("\n", *[F.concat(F.lit(name), value) for name, value in lines])


def next_try(status_code: Column, error: Column, attempt: Column, retry_after: Column, body: Column, max_chars: Column, backoff: float = 1.0, most: float = 60.0, attempts: int = 3) -> dict[str, Column]:
    """What follows a model's reply: action (done, retry or next_provider), wait in seconds without the random part, and the
    characters that the next try may send. attempt counts from 0. error: null, `network`, `invalid`, `no_key` or other.

    A 429 waits as long as its header says, or its body, a second more, or twice as long each time; a 413 sends six tenths;
    a broken connection waits twice as long each time. All else, and the last attempt, is left to the next provider."""
    grown = F.lit(backoff) * F.pow(F.lit(2.0), attempt)
    spoken = F.nullif(F.regexp_extract(body, r"(?i)retry in ([0-9.]+)s", 1), F.lit(""))
    stated = F.nullif(F.regexp_extract(body, r'"retryDelay":\s*"([0-9.]+)s"', 1), F.lit(""))
    limited, large = F.coalesce(status_code == 429, F.lit(False)), F.coalesce(status_code == 413, F.lit(False))
    broken = F.coalesce(error == "network", F.lit(False))
    waited = F.coalesce(retry_after.try_cast("double"), F.coalesce(spoken, stated).try_cast("double") + 1, grown)
    again = (limited | large | broken) & (attempt + 1 < attempts)
    done = F.coalesce((status_code == 200) & error.isNull(), F.lit(False))
    return {
        "action": F.when(done, "done").when(again, "retry").otherwise("next_provider"),
        "wait": F.when(again, F.when(limited, F.least(F.lit(most), waited)).when(large, F.lit(0.5)).otherwise(grown)).otherwise(0.0),
        "max_chars": F.when(large, F.greatest(F.lit(1000), F.floor(max_chars * 0.6))).otherwise(max_chars).cast("long"),
    }


def enrich(records: DataFrame, answers: DataFrame, as_of: Column, key: str = "input_idx") -> DataFrame:
    """Records with the descriptions of their answers (key, success, provider, raw, error), cleaned; adds enrichment_status
    (enriched, failed or skipped_unverified), enrichment_provider and enrichment_errors. Records that aren't verified are
    skipped; an answer must have both descriptions, else the record keeps its own."""
    own = [c for c in records.columns if c not in ("enrichment_status", "enrichment_provider", "enrichment_errors")]
    given = answers.select(F.col(key).alias("of"), F.col("success").alias("ok"), F.col("provider").alias("by"), text.json_object(F.col("raw")).alias("data"), F.col("error").alias("why"))
    said = lambda c: text.without_hype(text.tidy_description(F.coalesce(F.try_variant_get("data", f"$.{c}", "string"), F.lit(""))))
    joined = records.select(*own).join(given, F.col(key) == F.col("of"), "left").withColumns({"new_short": said("short_description"), "new_detailed": said("detailed_overview")})
    wanted = F.coalesce(F.col("verification_status").isin(*VERIFIED), F.lit(False))
    good = F.coalesce(wanted & F.col("ok") & F.col("data").isNotNull() & (F.col("new_short") != "") & (F.col("new_detailed") != ""), F.lit(False))
    chosen = {"short_description": F.when(good, F.col("new_short")).otherwise(F.col("short_description")), "detailed_overview": F.when(good, F.col("new_detailed")).otherwise(F.col("detailed_overview")), "updated_at": as_of}
    reason = F.coalesce(F.nullif("why", F.lit("")), F.lit("LLM returned empty description fields."))
    return joined.select(
        *[chosen[c].alias(c) if c in chosen else F.col(c) for c in own],
        F.when(good, "enriched").when(wanted, "failed").otherwise("skipped_unverified").alias("enrichment_status"),
        F.when(good, F.col("by")).alias("enrichment_provider"),
        F.when(wanted & ~good, F.array(reason)).otherwise(F.array().cast("array<string>")).alias("enrichment_errors"),
    )


def enrichment_report(records: DataFrame) -> DataFrame:
    """One row: records by outcome, those left without any description, and the providers that answered, in order."""
    status = F.col("enrichment_status")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return records.agg(
        F.count("*").alias("records_attempted"),
        F.count_if(status == "enriched").alias("descriptions_successfully_generated"),
        F.count_if(status == "failed").alias("failures"),
        F.count_if(status == "skipped_unverified").alias("skipped_unverified"),
        F.count_if((status == "failed") & blank("short_description") & blank("detailed_overview")).alias("records_with_missing_descriptions"),
        F.array_join(F.array_sort(F.collect_set("enrichment_provider")), ", ").alias("providers_used"),
    )
