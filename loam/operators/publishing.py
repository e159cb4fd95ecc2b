"""Rows as they are shown and published: strings only, with audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam import schemas
from loam.functions import dates, urls
from loam.functions import text as strings
from loam.operators import reporting

# Cells that mean a missing value got through, and shapes of credentials.
BAD_CELLS = ("none", "null", "nan", "undefined")
SECRETS = (r"AIza[0-9A-Za-z_\-]{20,}", r"sk-[A-Za-z0-9]{20,}", r"-----BEGIN [A-Z ]*PRIVATE KEY-----")


def flag(b: Column) -> Column:
    return F.when(b, "True").when(~b, "False").otherwise("")


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def instant(t: Column) -> Column:
    return F.coalesce(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss+00:00"), F.lit(""))


def listed(a: Column, by: str = ", ") -> Column:
    return F.coalesce(F.array_join(a, by), F.lit(""))


def points(m: Column) -> Column:
    """A map of numbers as JSON with blanks after its marks, keys in order of name."""
    pairs = F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"].cast("string"))))
    return F.coalesce(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")), F.lit(""))


def cell(c: str, kind: str) -> Column:
    col = F.col(c)
    if kind == "boolean":
        return flag(col)
    if kind.startswith("array"):
        return listed(col)
    if kind.startswith("map"):
        return points(col)
    return instant(col) if kind == "timestamp" else text(col)


def tool_rows(tools: DataFrame) -> DataFrame:
    """Products as rows of strings in the published order."""
    return tools.select(*[cell(c, kind).alias(c) for c, kind in schemas.TOOL.items()])


#: Columns that hold a flag or a text.
FLAG_OR_TEXT = ("api_availability", "open_source_status", "signup_requirement")


def read_tool_rows(rows: DataFrame) -> DataFrame:
    """Products of rows of strings, as people may have written them: blank cells are null, lists are separated by commas, flags
    are said in several ways, numbers as prices become dollars, and what can't be read is null."""

    def back(c: str, kind: str) -> Column:
        v = strings.blank_to_null(F.col(c))
        if kind == "boolean":
            return strings.as_bool(v)
        if kind == "array<string>":
            return strings.as_list(v)
        if kind == "timestamp":
            return dates.instant(v)
        if kind.startswith("map"):
            return F.from_json(v, kind)
        if c in FLAG_OR_TEXT:
            return strings.as_bool_text(v)
        return strings.as_price(v) if c == "starting_price" else v.try_cast(kind)

    return rows.select(*[back(c, k).alias(c) for c, k in schemas.TOOL.items()])


def _head(kind: str, item: Column, fallback: Column | str | None = None) -> list[Column]:
    """The columns that all sheets begin with. A source without a name is called after its address, or as given."""
    url = text(F.col("source.url"))
    named = F.coalesce(F.nullif(F.col("source.name"), F.lit("")), F.lit(fallback) if isinstance(fallback, str) else urls.brand(F.col("source.url")))
    return [
        F.coalesce("schemaVersion", F.lit("1.0")).alias("schemaVersion"),
        F.coalesce("recordType", F.lit(kind)).alias("recordType"),
        named.alias("sourceName"),
        url.alias("sourceUrl"),
        F.coalesce(F.nullif(item.cast("string"), F.lit("")), url).alias("itemUrl"),
    ]


def startup_rows(df: DataFrame) -> DataFrame:
    """Records of startups as rows; itemUrl is the company's page, else the source's."""
    d = "content.data."
    return df.select(
        *_head("STARTUP", F.col(d + "company_url")),
        text(F.col("content.entityName")).alias("entityName"),
        text(F.col(d + "employeeCount")).alias("employeeCount"),
        text(F.col(d + "website")).alias("website"),
        listed(F.col(d + "industries")).alias("industries"),
        text(F.col(d + "description")).alias("description"),
        instant(F.col("collectedAt")).alias("collectedAt"),
    )


def product_rows(df: DataFrame) -> DataFrame:
    return df.select(
        *_head("PRODUCT", F.col("content.product_url")),
        *[text(F.col(f"content.{c}")).alias(c) for c in ("productName", "startupName", "pricingModel")],
        text(F.col("content.product_url")).alias("productUrl"),
        instant(F.col("collectedAt")).alias("collectedAt"),
    )


def paper_rows(df: DataFrame) -> DataFrame:
    """Records of papers as rows; stars of 0 stay 0."""
    return df.select(
        *_head("RESEARCH_PAPER", F.lit(None), "arXiv")[:4],
        text(F.col("content.title")).alias("title"),
        listed(F.col("content.authors"), "; ").alias("authors"),
        *[text(F.col(f"content.{c}")).alias(to) for c, to in (("paper_url", "paperUrl"), ("github_url", "githubUrl"), ("github_stars", "githubStars"))],
        instant(F.col("content.published_date")).alias("publishedDate"),
        instant(F.col("collectedAt")).alias("collectedAt"),
    )


def job_rows(df: DataFrame) -> DataFrame:
    """Records of jobs as rows; the title is the role, unless there is none."""
    said = lambda c: F.nullif(F.col(f"content.{c}"), F.lit(""))
    return df.select(
        *_head("JOB", F.col("content.url")),
        text(F.col("content.company")).alias("company"),
        F.coalesce(said("title"), said("role"), F.lit("")).alias("role"),
        instant(F.col("content.date")).alias("date"),
        flag(F.col("content.is_remote")).alias("isRemote"),
        F.coalesce(said("role_family"), F.lit("Engineering / AI")).alias("roleFamily"),
        instant(F.col("collectedAt")).alias("collectedAt"),
    )


def news_rows(df: DataFrame) -> DataFrame:
    return df.select(
        *_head("NEWS", F.col("content.url")),
        text(F.col("content.title")).alias("title"),
        instant(F.col("content.published_date")).alias("date"),
        instant(F.col("collectedAt")).alias("collectedAt"),
        text(F.col("content.text")).alias("content"),
    )


def mapping_rows(df: DataFrame) -> DataFrame:
    """Log entries as rows; without confidence they are certain, without a reason they name the method."""
    url = F.coalesce(F.nullif(F.col("source.url"), F.lit("")), F.col("source_url"), F.lit(""))
    method = text(F.col("match_type"))
    return df.select(
        F.coalesce("schemaVersion", F.lit("1.0")).alias("schemaVersion"),
        F.coalesce("recordType", F.lit("ENTITY_MAPPING_LOG")).alias("recordType"),
        F.coalesce("source.name", F.lit("Entity Resolver")).alias("sourceName"),
        url.alias("sourceUrl"),
        F.coalesce(F.nullif("item_url", F.lit("")), url).alias("itemUrl"),
        text(F.col("raw_name")).alias("rawName"),
        text(F.col("canonical_name")).alias("canonicalName"),
        method.alias("matchType"),
        text(F.col("entity_type")).alias("entityType"),
        F.coalesce(F.col("confidence"), F.lit(1.0)).cast("string").alias("confidence"),
        F.coalesce("reason", F.concat(F.lit("Matched via "), method)).alias("reason"),
    )


def bad_cells(rows: DataFrame) -> DataFrame:
    """(column, value) of cells that must not be published."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in rows.columns])
    value = F.lower(F.trim("value"))
    return rows.select(F.inline(cells)).where(value.isin(*BAD_CELLS) | F.regexp_like("value", F.lit("|".join(SECRETS))))


def chunked(rows: DataFrame, order: str, size: int = 500, by: Sequence[str] = ()) -> DataFrame:
    """Add chunk, from 0, for writes of `size` rows; `by` lets tasks number their rows apart."""
    return rows.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1) / size).cast("long"))


def records_json(df: DataFrame) -> DataFrame:
    """(record): every row as a JSON object, with its nulls."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def _path(spark, where: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def surplus(spark, path: str, wanted: Sequence[str], remove: bool = False) -> list[str]:
    """Tables under a path that aren't wanted; removed on demand."""
    folder, files = _path(spark, path)
    names = sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()) if files.exists(folder) else []
    found = [n for n in names if n not in wanted]
    for name in found if remove else ():
        files.delete(_path(spark, f"{path}/{name}")[0], True)
    return found


def publish(tables: dict[str, DataFrame], path: str, format: str = "parquet", clean: bool = False) -> DataFrame:
    """Write every table of strings, overwriting, as Parquet, CSV or JSON; a table with a bad cell is not written. Returns a
    report (name, records, bad_cells, written). With clean, other tables under the path go."""
    report, spark = [], next(iter(tables.values())).sparkSession
    for name, rows in tables.items():
        bad = bad_cells(rows).count()
        if not bad:
            writer = rows.write.mode("overwrite")
            (writer.option("header", True).csv if format == "csv" else getattr(writer, format))(f"{path}/{name}")
        report.append((name, rows.count(), bad, not bad))
    if clean:
        surplus(spark, path, list(tables), remove=True)
    return spark.createDataFrame(report, "name string, records long, bad_cells long, written boolean")


#: How records of each sheet become rows.
SHEETS = {"Startups": startup_rows, "Products": product_rows, "Research Papers": paper_rows, "Jobs": job_rows, "News": news_rows, "Entity Mapping Log": mapping_rows}


def export(datasets: dict[str, DataFrame], path: str | None = None) -> DataFrame:
    """Check all datasets of SHEETS, publish their rows and remove other tables. Without a path they are only checked. Returns
    the checks, with what was written."""
    checks = reporting.dataset_validation(datasets)
    if path is None:
        return checks
    written = publish({name: SHEETS[name](df) for name, df in datasets.items()}, path, clean=True)
    return checks.join(written, "name")


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row, or few, as JSON."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
