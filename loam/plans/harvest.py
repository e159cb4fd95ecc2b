"""Startups, products and papers: resolve, first of each key, check, cap, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import urls
from loam.functions.text import entity_key
from loam.operators import resolution

# What marks a company as one of the field; the short ones only between blanks.
FIELD_WORDS = ("artificial intelligence", "machine learning", "deep learning", "generative", "llm", "nlp", "computer vision", "neural", "gpt", " ai ", "ai-powered", "ai agent", "chatbot")


def in_field(*columns: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *columns))
    return F.regexp_like(text, F.lit("|".join(FIELD_WORDS)))


def capped(df: DataFrame, valid: Column, order: str, target: int) -> DataFrame:
    """The first `target` valid rows: each task keeps that many at most."""
    return df.where(valid).orderBy(order).limit(target)


def startups(raw: DataFrame, dims: dict[str, DataFrame], as_of: Column, target: int = 1000, order: str = "input_idx") -> DataFrame:
    """Envelopes of startups (entityName, company_url, website, employeeCount, industries, description, source_name,
    source_url). The first of a resolved name counts even if it is not valid then."""
    named = resolution.resolve_startups(raw.where(F.length(F.trim("entityName")) >= 2), dims, "entityName")
    first = resolution.first_of(named.withColumn("__key", entity_key(F.col("canonical_name"))), ["__key"], [order])
    valid = F.col("source_url").isNotNull() & F.coalesce(F.col("company_url"), urls.with_scheme(F.col("website"))).isNotNull()
    data = F.struct("employeeCount", urls.with_scheme(F.col("website")).alias("website"), "company_url", "industries", "description")
    return capped(first, valid, order, target).select(
        F.lit("1.0").alias("schemaVersion"),
        F.lit("STARTUP").alias("recordType"),
        F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url")).alias("source"),
        F.struct(F.col("canonical_name").alias("entityName"), data.alias("data")).alias("content"),
        as_of.alias("collectedAt"),
    )


def products(raw: DataFrame, dims: dict[str, DataFrame], as_of: Column, target: int = 1000, order: str = "input_idx") -> DataFrame:
    """Envelopes of products (productName, startupName, pricingModel, product_url, source_name, source_url): one for each
    name and owner, or name and address where no owner is known."""
    named = resolution.resolve_products(raw.where(F.length(F.trim("productName")) >= 2), dims, "productName", "startupName")
    owner = entity_key(F.col("owner"))
    key = F.concat_ws("\u0001", entity_key(F.col("canonical_name")), F.when(owner != "", owner).otherwise(F.coalesce("product_url", F.lit(""))))
    first = resolution.first_of(named.withColumn("__key", key), ["__key"], [order])
    model = F.upper(F.trim("pricingModel"))
    valid = F.col("source_url").isNotNull() & (model.isNull() | model.isin(*schemas.PRICING_MODELS))
    return capped(first, valid, order, target).select(
        F.lit("1.0").alias("schemaVersion"),
        F.lit("PRODUCT").alias("recordType"),
        F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url")).alias("source"),
        F.struct(F.col("canonical_name").alias("productName"), F.col("owner").alias("startupName"), model.alias("pricingModel"), "product_url").alias("content"),
        as_of.alias("collectedAt"),
    )


def papers(entries: DataFrame, repositories: DataFrame, as_of: Column, order: str = "input_idx") -> DataFrame:
    """Papers with the repositories known for them (arxiv_id, github_url, github_stars); none is lost for want of one."""
    first = resolution.first_of(entries, ["arxiv_id"], [order])
    own = repositories.select("arxiv_id", F.regexp_replace("github_url", "^http://", "https://").alias("__url"), F.col("github_stars").try_cast("int").alias("__stars"))
    known = own.where(F.contains("__url", F.lit("github.com"))).groupBy("arxiv_id").agg(F.max(F.struct("__stars", "__url")).alias("r"))
    return first.join(known, "arxiv_id", "left").withColumns({"github_url": F.col("r.__url"), "github_stars": F.col("r.__stars")}).drop("r")


def batch_totals(entries: DataFrame, key: str = "arxiv_id", batch: str = "batch", order: str = "input_idx") -> DataFrame:
    """(batch, fetched, new): entries by batch, and those whose key no earlier one had."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(batch, order)) == 1
    return entries.withColumn("__first", first).groupBy(batch).agg(F.count("*").alias("fetched"), F.count_if("__first").alias("new"))
