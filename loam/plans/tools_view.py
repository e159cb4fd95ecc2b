"""Products made from the driver's documents and labels, by expressions that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import text, urls
from loam.operators import validation
from loam.sources.files import table

AS_OF = "2026-09-12 12:00:00"



def _nth(by: int, *values: str) -> str:
    """SQL for one of the values, by how many times `by` goes into doc_id."""
    return f"CASE CAST(floor(doc_id / {by}) AS BIGINT) % {len(values)} " + " ".join(f"WHEN {i} THEN '{v.replace(chr(39), chr(39) * 2)}'" for i, v in enumerate(values)) + " END"


SCALARS = {
    "input_idx": "doc_id",
    "record_id": f"CASE WHEN doc_id % 37 = 0 THEN {_nth(37, 'N/A', 'none', ' NULL ', 'Unknown', 'tbd', 'not specified')} ELSE 'r' || doc_id END",
    "tool_name": "CASE WHEN doc_id % 19 = 0 THEN ' ' ELSE 'Tool ' || doc_id END",
    "official_website": f"CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'https://' || {_nth(11, *urls.VALIDATOR_DIRECTORIES)} || '/ai-tools/x' || doc_id WHEN doc_id % 29 = 0 THEN 'no address' ELSE 'https://www.site' || (doc_id % 4000) || '.example.com/p' || (doc_id % 3) || '/?utm_source=a' END",
    "company_developer": "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN '[Company]' ELSE 'Dev ' || (doc_id % 50) END",
    "current_status": "CASE WHEN doc_id % 61 = 0 THEN '<status>' ELSE CASE doc_id % 7 WHEN 0 THEN 'Active' WHEN 1 THEN 'Beta' WHEN 2 THEN 'Active' WHEN 3 THEN 'Pre-launch' WHEN 4 THEN 'Deprecated' WHEN 5 THEN 'Discontinued' END END",
    "verification_status": "CASE WHEN doc_id % 5 < 3 THEN 'verified' WHEN doc_id % 5 = 3 THEN 'partially_verified' ELSE 'unverified' END",
    "short_description": f"CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 43 = 0 THEN 'A ' || {_nth(43, *text.HYPE_WORDS)} || ' thing at $5 per seat' ELSE 'A tool for ' || lang || ' texts of ' || source END",
    "detailed_overview": "CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END",
    "primary_task": "CASE WHEN doc_id % 53 = 0 THEN '[task]' ELSE CASE doc_id % 4 WHEN 0 THEN 'Developer tools' WHEN 1 THEN 'Misc' WHEN 2 THEN 'ab' END END",
    "api_availability": "CASE doc_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'GraphQL' WHEN 2 THEN 'maybe' END",
    "open_source_status": "CASE WHEN doc_id % 31 = 0 THEN 'MIT' END",
    "version": "CASE WHEN doc_id % 47 = 0 THEN '<1.0>' WHEN doc_id % 8 = 0 THEN '1.0' END",
    "country": "CASE WHEN doc_id % 59 = 0 THEN ' [Land] ' WHEN doc_id % 9 = 0 THEN 'France' END",
    "pricing_model": "CASE WHEN doc_id % 71 = 0 THEN '<price>' ELSE CASE doc_id % 4 WHEN 0 THEN 'Free' WHEN 1 THEN 'Paid' WHEN 2 THEN 'Custom' END END",
    "starting_price": "CASE WHEN doc_id % 73 = 0 THEN '[$]' WHEN doc_id % 9 = 1 THEN '$9/month' END",
    "important_usage_limits": "CASE WHEN doc_id % 79 = 0 THEN '<none>' END",
    "logo_url": f"CASE WHEN doc_id % 2 = 0 THEN 'https://site' || (doc_id % 4000) || '.example.com/logo.png' WHEN doc_id % 10 = 1 THEN 'https://other.example.org/l.png' WHEN doc_id % 10 = 3 THEN 'https://img' || {_nth(10, *validation.LOGO_HOSTS)} || '/l.png' WHEN doc_id % 10 = 5 THEN 'https://cdn.site' || (doc_id % 4000) || '.example.com/l.png' WHEN doc_id % 20 = 7 THEN 'logo.png' END",
    "usage_adoption_signals": "CASE quality WHEN 1 THEN '120 users' WHEN 0 THEN 'mentioned once' END",
}
FLAGS = {"free_plan": "CASE WHEN doc_id % 4 = 0 THEN true END"}
#: How many items each list has, and the items.
COUNTS = {
    "categories": ("doc_id % 3", ("General", "Design kit")),
    "inputs": ("doc_id % 4", ("Text", "Image", "Audio")),
    "outputs": ("CAST(floor(doc_id / 4) AS BIGINT) % 3", ("Text", "Code")),
    "supported_platforms": ("doc_id % 3", ("Web", "iOS")),
    "ai_capabilities": ("doc_id % 5", ("a", "b", "c", "d")),
    "key_features": ("CASE WHEN doc_id % 67 = 0 THEN 2 ELSE doc_id % 2 END", ("f", "TBD")),
    "main_use_cases": ("CAST(floor(doc_id / 2) AS BIGINT) % 3", ("u", "v")),
    "pros": ("CASE WHEN doc_id % 83 = 0 THEN 2 ELSE 0 END", ("n/a", "Nil")),
    "sources": ("doc_id % 3", ("one", "two")),
}
AGE = "CASE WHEN doc_id % 5 <> 0 THEN doc_id % 1000 END"


def tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as products: all columns of a product between stages."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.select("doc_id", "text", "lang", "source").join(labels.select("doc_id", "quality"), "doc_id", "left")
    lists = {c: F.slice(F.array(*[F.lit(x) for x in items]), F.lit(1), F.expr(n).cast("int")) for c, (n, items) in COUNTS.items()}
    refs = F.transform(lists.pop("sources"), lambda s: F.struct(s.alias("source"), s.alias("source_url"), F.concat(s, F.lit("/"), F.col("doc_id")).alias("discovered_url"), F.lit(None).cast("string").alias("discovered_at")))
    as_of = F.lit(AS_OF).cast("timestamp")
    made = {c: F.expr(e) for c, e in (SCALARS | FLAGS).items()} | lists
    made |= {"discovery_references": refs, "last_verified_date": as_of, "launch_date": as_of - F.make_dt_interval(F.expr(AGE).cast("int"))}
    rest = {c: F.lit(None).cast(k) for c, k in (schemas.TOOL | schemas.STAGE).items() if c not in made}
    return joined.select(*[x.alias(c) for c, x in (made | rest).items()])


TOOLS_SQL = f"""tools AS (
  SELECT {', '.join(f'{e} AS {c}' for c, e in (SCALARS | FLAGS).items())},
    {', '.join(f'{n} AS n_{c}' for c, (n, _) in COUNTS.items())}, {', '.join(f'{list(items)!r}[1:({n})] AS {c}' for c, (n, items) in COUNTS.items() if c != 'sources')}, {AGE} AS age
  FROM documents LEFT JOIN labels USING (doc_id))"""

SCORED_SQL = (
    TOOLS_SQL
    + """,
points AS (
  SELECT *, lower(coalesce(current_status, '')) AS status,
    CASE WHEN regexp_matches(coalesce(official_website, ''), '^https?://') THEN lower(regexp_extract(official_website, '://([^/?#]*)', 1)) ELSE '' END AS host
  FROM tools),
criteria AS (
  SELECT *,
    least(25.0, CASE WHEN length(trim(primary_task)) > 2 THEN 6 ELSE 0 END + least(4, n_inputs * 2) + least(4, n_outputs * 2) + least(4, n_supported_platforms * 2)
      + least(4, n_ai_capabilities + n_key_features) + CASE WHEN lower(api_availability) IN ('true', 'rest api', 'graphql', 'api available') THEN 3 ELSE 0 END) AS capability,
    least(20.0, CASE WHEN primary_task = 'Developer tools' OR n_categories = 2 THEN 10 WHEN n_categories > 0 OR primary_task IS NOT NULL THEN 6 ELSE 0 END
      + CASE WHEN length(detailed_overview) > 60 AND length(short_description) > 20 THEN 6 WHEN short_description <> '' THEN 3 ELSE 0 END
      + CASE WHEN n_main_use_cases > 0 THEN least(4, n_main_use_cases * 2) WHEN n_inputs > 0 AND n_outputs > 0 THEN 2 ELSE 0 END) AS usefulness,
    least(15.0, CASE WHEN usage_adoption_signals = '120 users' THEN 12 WHEN usage_adoption_signals IS NOT NULL THEN 6 ELSE 0 END
      + CASE WHEN verification_status = 'verified' AND status = 'active' THEN 2 ELSE 0 END + CASE n_sources WHEN 2 THEN 3 WHEN 1 THEN 1 ELSE 0 END) AS adoption,
    CASE WHEN status = 'active' THEN 15.0 WHEN status = 'beta' THEN 10 WHEN status = 'pre-launch' THEN 4 WHEN status = 'deprecated' THEN 0 WHEN verification_status = 'verified' THEN 5 ELSE 1 END AS activity,
    CASE WHEN company_developer IS NOT NULL THEN 4 ELSE 0 END + CASE WHEN host <> '' THEN 1 ELSE 0 END + CASE WHEN version IS NOT NULL THEN 2 ELSE 0 END
      + CASE WHEN lower(pricing_model) IN ('free', 'paid') THEN 3 ELSE 0 END AS maturity,
    CASE WHEN age <= 365 THEN 5 WHEN age <= 730 THEN 4 WHEN age IS NOT NULL THEN 2 ELSE 3 END AS recency,
    CASE WHEN n_inputs < 2 AND n_outputs < 2 AND n_supported_platforms < 2 AND api_availability IS NULL THEN 1.0 ELSE
      CASE WHEN n_inputs >= 2 OR n_outputs >= 2 THEN 2 ELSE 0 END + CASE WHEN n_supported_platforms >= 2 THEN 1.5 ELSE 0 END + CASE WHEN api_availability IS NOT NULL THEN 1.5 ELSE 0 END END AS differentiation,
    CASE WHEN verification_status = 'verified' AND official_website IS NOT NULL THEN 2 WHEN official_website IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN starts_with(logo_url, 'http') THEN 1 ELSE 0 END
      + CASE WHEN pricing_model IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN short_description <> '' AND detailed_overview <> '' THEN 1 ELSE 0 END AS information_quality
  FROM points),
totals AS (
  SELECT *, round(CAST(capability + usefulness + adoption + activity + maturity + recency + differentiation + information_quality AS DOUBLE), 1) AS quality_score FROM criteria),
scored AS (
  SELECT *, CASE WHEN quality_score >= 90 THEN 'Exceptional' WHEN quality_score >= 80 THEN 'Excellent' WHEN quality_score >= 70 THEN 'Good' WHEN quality_score >= 60 THEN 'Average / Skip' ELSE 'Reject' END AS quality_tier
  FROM totals),
judged AS (
  SELECT *, CASE
    WHEN status = 'deprecated' THEN 'Tool status is inactive/deprecated: ''' || status || ''''
    WHEN verification_status = 'unverified' THEN 'Verification failed or unverified: ''unverified'''
    WHEN official_website IS NULL THEN 'Missing canonical official website'
    WHEN regexp_matches(host, 'theresanaiforthat[.]com|creati[.]ai|producthunt[.]com') THEN 'Directory URL cannot serve as official product website'
    WHEN coalesce(short_description, '') = '' THEN 'Missing short_description'
    WHEN coalesce(detailed_overview, '') = '' THEN 'Missing detailed_overview'
    WHEN quality_score < 60 THEN 'Quality score ' || printf('%.1f', quality_score) || ' below threshold (60.0)'
    WHEN quality_score < 70 AND NOT (api_availability IS NOT NULL OR open_source_status IS NOT NULL
      OR (verification_status = 'verified' AND status = 'active' AND logo_url IS NOT NULL AND pricing_model IS NOT NULL AND (n_inputs > 0 OR n_outputs > 0)))
    THEN 'Score ' || printf('%.1f', quality_score) || ' in 60-69 range without distinctive qualifying justification' END AS rejection_reason
  FROM scored)"""
)
