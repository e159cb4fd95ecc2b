"""Schemas of the records that the pipelines pass on."""

from __future__ import annotations

LISTS = (
    "categories", "tags", "key_features", "main_use_cases", "ai_capabilities", "inputs", "outputs", "supported_platforms",
    "integrations", "pros", "cons", "limitations",
)

#: The published columns of a product, in order, with their types.
TOOL: dict[str, str] = {
    "record_id": "string", "entity_type": "string", "created_at": "timestamp", "updated_at": "timestamp", "tool_name": "string",
    "company_developer": "string", "official_website": "string", "logo_url": "string", "country": "string", "version": "string",
    "launch_date": "timestamp", "current_status": "string", "short_description": "string", "detailed_overview": "string",
    "primary_task": "string", "categories": "array<string>", "tags": "array<string>", "key_features": "array<string>",
    "main_use_cases": "array<string>", "ai_capabilities": "array<string>", "inputs": "array<string>", "outputs": "array<string>",
    "supported_platforms": "array<string>", "integrations": "array<string>", "api_availability": "string",
    "open_source_status": "string", "signup_requirement": "string", "pricing_model": "string", "starting_price": "string",
    "free_plan": "boolean", "free_trial": "boolean", "important_usage_limits": "string", "pros": "array<string>",
    "cons": "array<string>", "limitations": "array<string>", "ai_orbit_summary": "string", "usage_adoption_signals": "string",
    "quality_score": "double", "quality_score_breakdown": "map<string,double>", "quality_score_rationale": "string",
    "last_verified_date": "timestamp", "discovery_source": "string", "discovery_source_url": "string",
    "verification_source": "string", "verification_source_url": "string",
}
REFERENCE = "struct<source:string,source_url:string,discovered_url:string,discovered_at:string>"
#: Columns that products have between stages only.
STAGE = {"candidate_id": "string", "verification_status": "string", "verification_errors": "array<string>", "discovery_references": f"array<{REFERENCE}>"}
SOURCE = "struct<name:string,url:string>"
ENVELOPE = f"schemaVersion string, recordType string, source {SOURCE}"
STARTUP = f"{ENVELOPE}, content struct<entityName:string,data:struct<employeeCount:int,website:string,company_url:string,industries:array<string>,description:string>>, collectedAt timestamp"
PRODUCT = f"{ENVELOPE}, content struct<productName:string,startupName:string,pricingModel:string,product_url:string>, collectedAt timestamp"
PAPER = f"{ENVELOPE}, content struct<title:string,authors:array<string>,paper_url:string,github_url:string,github_stars:int,published_date:timestamp>, collectedAt timestamp"
JOB = f"{ENVELOPE}, content struct<url:string,title:string,company:string,role:string,role_family:string,date:timestamp,is_remote:boolean,is_date_only:boolean>, collectedAt timestamp"
NEWS = f"{ENVELOPE}, content struct<url:string,title:string,text:string,published_date:timestamp,is_date_only:boolean>, collectedAt timestamp"
MAPPING_LOG = f"{ENVELOPE}, raw_name string, canonical_name string, entity_type string, source_url string, match_type string, confidence double, item_url string, reason string"
CRAWL = "url string, status_code int, html string, success boolean, used_browser boolean, error string"
PRICING_MODELS = ("FREE", "FREEMIUM", "PAID", "ENTERPRISE")


def columns(fields: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in fields.items())
