"""Entity resolution against a dimension of known companies and their products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.functions.text import entity_key

#: Names up to which a dimension is broadcast; beyond it Spark joins by shuffle.
MAX_BROADCAST = 500_000

SEED_SCHEMA = "canonical_name string, aliases array<string>, products array<string>"


def seed_catalog(spark: SparkSession, rows: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> DataFrame:
    """A catalog of companies from the caller's list; `position` keeps its order."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"position int, {SEED_SCHEMA}")


def catalog_file(spark: SparkSession, path: str) -> DataFrame:
    """A catalog from a JSON array of SEED_SCHEMA, which must be there; in the file's order."""
    from loam.sources.files import json_array

    rows = json_array(spark, path, SEED_SCHEMA, required=True).withColumn("at", F.monotonically_increasing_id())
    return rows.select(F.col("at").cast("int").alias("position"), "canonical_name", "aliases", "products")


def _last(df: DataFrame, *keys: str) -> DataFrame:
    """The last row by position for each key: later entries overwrite earlier ones."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct("position", *[c for c in rest if c != "position"])).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest if c != "position"])


def dimensions(catalog: DataFrame) -> dict[str, DataFrame]:
    """Lookup tables of a catalog (position, canonical_name, aliases, products) by compared name."""
    own = catalog.withColumn("norm", entity_key(F.col("canonical_name")))
    aliases = own.select("position", "norm", "canonical_name", F.explode_outer("aliases").alias("alias")).withColumn("alias_norm", entity_key(F.col("alias")))
    products = own.select("position", "norm", "canonical_name", F.posexplode("products").alias("at", "product")).withColumn("product_norm", entity_key(F.col("product")))
    canonical = _last(own.where("norm != ''").select("position", "norm", "canonical_name"), "norm")
    return {
        "canonical": canonical,
        "alias": _last(aliases.where("alias_norm != '' and alias_norm != norm").select("position", F.col("alias_norm").alias("norm"), "canonical_name"), "norm"),
        "product": _last(products.where("product_norm != ''").select("position", F.col("norm").alias("owner_norm"), "product_norm", "product"), "owner_norm", "product_norm"),
        "only": products.where("product_norm != ''")
        .groupBy("product_norm")
        .agg(F.countDistinct("norm").alias("owners"), F.max("canonical_name").alias("owner"), F.max_by("product", "position").alias("product"))
        .where("owners = 1")
        .drop("owners"),
    }


def small(df: DataFrame, max_rows: int = MAX_BROADCAST) -> DataFrame:
    """Broadcast a dimension if its counted rows are few."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def resolve_startups(df: DataFrame, dims: dict[str, DataFrame], name: str = "raw_name", prefix: str = "") -> DataFrame:
    """Add canonical_name, match_method (EXACT, ALIAS or UNRESOLVED) and confidence. An unresolved name stays as it is."""
    raw = F.trim(F.coalesce(F.col(name), F.lit("")))
    canonical, alias = (small(dims[k].select(F.col("norm").alias(f"__{k}"), F.col("canonical_name").alias(f"__{k}_name"))) for k in ("canonical", "alias"))
    out = df.withColumn("__norm", entity_key(raw)).join(canonical, F.col("__norm") == F.col("__canonical"), "left").join(alias, F.col("__norm") == F.col("__alias"), "left")
    method = F.when(F.col("__canonical_name").isNotNull(), "EXACT").when(F.col("__alias_name").isNotNull(), "ALIAS").otherwise("UNRESOLVED")
    chosen = F.when(F.col("__norm") == "", "").otherwise(F.coalesce("__canonical_name", "__alias_name", raw))
    return out.withColumns({f"{prefix}canonical_name": chosen, f"{prefix}match_method": method, f"{prefix}confidence": F.when(method == "UNRESOLVED", 0.0).otherwise(1.0)}).drop("__norm", "__canonical", "__canonical_name", "__alias", "__alias_name")


def resolve_products(df: DataFrame, dims: dict[str, DataFrame], name: str = "raw_name", context: str = "startup_context") -> DataFrame:
    """Add canonical_name, match_method, confidence and owner. A product with an owner given is looked up under that
    owner only; without one it must belong to a single company of the catalog."""
    raw = F.trim(F.coalesce(F.col(name), F.lit("")))
    given = F.coalesce(F.col(context) != "", F.lit(False))
    out = resolve_startups(df, dims, context, "__owner_").withColumn("__given", F.when(given, F.when(F.col("__owner_confidence") > 0, F.col("__owner_canonical_name")).otherwise(F.col(context))))
    out = out.withColumns({"__norm": entity_key(raw), "__of": entity_key(F.col("__given"))})
    product = small(dims["product"].select(F.col("owner_norm").alias("__o"), F.col("product_norm").alias("__p"), F.col("product").alias("__product")))
    only = small(dims["only"].select(F.col("product_norm").alias("__q"), F.col("owner").alias("__only_owner"), F.col("product").alias("__only")))
    out = out.join(product, (F.col("__of") == F.col("__o")) & (F.col("__norm") == F.col("__p")), "left").join(only, F.col("__norm") == F.col("__q"), "left")
    found = F.when(F.col("__given").isNotNull(), F.col("__product")).otherwise(F.col("__only"))
    owner = F.when(F.col("__given").isNotNull(), F.col("__given")).otherwise(F.col("__only_owner"))
    own = [c for c in df.columns if c not in ("canonical_name", "match_method", "confidence", "owner")]
    return out.select(
        *own,
        F.when(F.col("__norm") == "", "").otherwise(F.coalesce(found, raw)).alias("canonical_name"),
        F.when(found.isNotNull(), "EXACT").otherwise("UNRESOLVED").alias("match_method"),
        F.when(found.isNotNull(), 1.0).otherwise(0.0).alias("confidence"),
        owner.alias("owner"),
    )


def resolve(df: DataFrame, dims: dict[str, DataFrame], kind: str = "entity_type") -> DataFrame:
    """Resolve rows of startups and products, each in its own way; names of other kinds stay, unresolved."""
    at = F.upper(F.trim(F.col(kind)))
    startups = resolve_startups(df.where(at == "STARTUP"), dims).withColumn("owner", F.col("startup_context"))
    products = resolve_products(df.where(at == "PRODUCT"), dims)
    others = df.where(~F.coalesce(at.isin("STARTUP", "PRODUCT"), F.lit(False))).withColumns({"canonical_name": F.col("raw_name"), "match_method": F.lit("UNRESOLVED"), "confidence": F.lit(0.0), "owner": F.col("startup_context")})
    return startups.unionByName(products).unionByName(others)


def mapping_log(resolved: DataFrame) -> DataFrame:
    """Rows of resolve() as a log: addresses that are none are replaced, kinds other than startups are products."""
    url = F.when(F.startswith("source_url", F.lit("http")), F.col("source_url")).otherwise("https://unknown.source")
    return resolved.select(
        F.lit("1.0").alias("schemaVersion"),
        "raw_name",
        "canonical_name",
        F.when(F.upper(F.trim("entity_type")) == "STARTUP", "STARTUP").otherwise("PRODUCT").alias("entity_type"),
        F.coalesce(url, F.lit("https://unknown.source")).alias("source_url"),
        F.col("match_method").alias("match_type"),
        "confidence",
        F.concat(F.lit("Matched via "), "match_method").alias("reason"),
    )


def typed_key(kind: Column, name: Column, owner: Column, url: Column) -> Column:
    """What makes a record one of its kind: startups their name, products name and owner, items their address."""
    return (
        F.when(kind == "STARTUP", F.concat_ws("\u0001", kind, entity_key(name)))
        .when(kind == "PRODUCT", F.concat_ws("\u0001", kind, entity_key(name), entity_key(owner)))
        .when(kind.isin("NEWS", "JOB"), F.concat_ws("\u0001", kind, F.rtrim(F.coalesce(url, F.lit("")), F.lit("/"))))
        .otherwise(F.concat_ws("\u0001", kind, F.coalesce(url, F.lit(""))))
    )


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row by `order` for each key: an aggregate, so most rows go before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    least = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(least.alias("__r")).select(*[F.col(c) if c in keys else F.col("__r").getField(c).alias(c) for c in df.columns])


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], to: str = "rank") -> DataFrame:
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
