"""Nested records as the flat tables that a dashboard shows. Values stay typed; 0 is a value like any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _list(c: Column) -> Column:
    return F.coalesce(F.array_join(c, ", "), F.lit(""))


def _common(collected: str = "collectedAt", source: str = "name") -> list[Column]:
    return [F.col(f"source.{source}").alias("Source"), F.col(collected).alias("Collected")]


def startups(df: DataFrame) -> DataFrame:
    data = "content.data."
    shown = {"Startup": F.col("content.entityName"), "Employees": F.col(data + "employeeCount"), "Website": F.col(data + "website"), "Industries": _list(F.col(data + "industries")), "Description": F.col(data + "description")}
    return df.select(*[v.alias(k) for k, v in shown.items()], *_common())


def products(df: DataFrame) -> DataFrame:
    shown = {"Product": "productName", "Startup": "startupName", "Pricing": "pricingModel", "Product URL": "product_url"}
    return df.select(*[F.col(f"content.{v}").alias(k) for k, v in shown.items()], *_common())


def papers(df: DataFrame) -> DataFrame:
    """Papers have their fields at the top, or within content, or in part here and there."""
    either = lambda c: F.coalesce(F.col(c), F.col(f"content.{c}")) if c in df.columns else F.col(f"content.{c}")
    shown = {"Title": either("title"), "Authors": _list(either("authors")), "Published": either("published_date"), "GitHub Stars": either("github_stars"), "Paper URL": either("paper_url"), "GitHub": either("github_url")}
    return df.select(*[v.alias(k) for k, v in shown.items()], *_common())


def jobs(df: DataFrame) -> DataFrame:
    c = "content."
    shown = {"Company": F.col(c + "company"), "Role": F.coalesce(F.nullif(F.col(c + "role"), F.lit("")), F.col(c + "title")), "Date": F.col(c + "date"), "Remote": F.col(c + "is_remote"), "Job URL": F.col(c + "url")}
    return df.select(*[v.alias(k) for k, v in shown.items()], *_common("collected_at"))


def news(df: DataFrame) -> DataFrame:
    shown = {"Title": "title", "Published": "published_date", "News URL": "url"}
    return df.select(*[F.col(f"content.{v}").alias(k) for k, v in shown.items()], *_common("collected_at", "url"))


def entity_logs(df: DataFrame) -> DataFrame:
    shown = {"Raw Name": "raw_name", "Canonical Name": "canonical_name", "Match Type": "match_type", "Entity Type": "entity_type", "Confidence": "confidence", "Reason": "reason"}
    return df.select(*[F.col(v).alias(k) for k, v in shown.items()])
