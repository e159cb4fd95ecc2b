"""Inputs from files: JSON arrays, Atom feeds, Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.urls import paper_id


def json_array(spark: SparkSession, path: str, schema: str, required: bool = False) -> DataFrame:
    """Files that hold a JSON array each. A missing, malformed or empty one is an empty table, unless it is required: then a
    missing one raises at once and a malformed one when it is read."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    kind = f"array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in spark.createDataFrame([], schema).schema)}>>"
    whole = F.json_array_length("value").isNotNull()
    broken = F.raise_error(F.concat(F.lit("no JSON array in "), F.input_file_name())) if required else F.lit(None)
    return files.select(F.inline(F.when(whole, F.from_json("value", kind)).otherwise(broken.cast(kind))))


def records(spark: SparkSession, path: str) -> int:
    """How many records a JSON array has, for reports; 0 if it can't be read."""
    try:
        return json_array(spark, path, "placeholder string").count()
    except (AnalysisException, PySparkException):
        return 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table; zone-less instants are UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"})


ENTRY = "id string, title string, published string, author array<struct<name:string>>"


def atom_entries(feeds: DataFrame, xml: Column) -> DataFrame:
    """Papers of Atom feeds, one row an entry; entries without title, id, date or authors go."""
    entries = feeds.withColumn("entry", F.explode(F.regexp_extract_all(xml, F.lit(r"(?s)<entry\b.*?</entry>"), F.lit(0))))
    read = entries.withColumn("e", F.from_xml("entry", ENTRY))
    out = read.select(
        paper_id(F.col("e.id")).alias("arxiv_id"),
        F.trim(F.regexp_replace("e.title", r"\s+", " ")).alias("title"),
        F.transform("e.author", lambda a: a["name"]).alias("authors"),
        F.trim("e.id").alias("paper_url"),
        F.trim("e.published").alias("published_date"),
    )
    return out.where("arxiv_id is not null and title != '' and published_date != '' and size(authors) > 0")
