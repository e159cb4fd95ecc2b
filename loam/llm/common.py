"""Helpers that the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words; all other characters belong to words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
#: Bytes of text that Python code handles at once, whatever the Arrow batch holds.
SLICE_BYTES = 4 << 20


#: Bytes and rows of an Arrow batch: texts can be long, and the JVM and Python hold a batch each. A longer row comes alone.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let batches that go to Python from this session be bounded by bytes; every operator that runs Python asks for it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it. Without one only a local master, whose executors are
    this process, may use its own temporary folder; a cluster must name one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = os.path.join(tempfile.gettempdir(), "loam-shared")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def shared_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(*tables: DataFrame, shuffles: bool = True) -> None:
    """Delete the files of shared tables that nothing will read again, and the shuffles of what has been written."""
    for df in tables:
        spark = df.sparkSession
        for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables and shuffles:
        release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffles that no plan needs any more: it does so when the driver's JVM collects garbage, which on a
    driver with memory to spare may be long after they have filled the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def return_memory() -> None:
    """Give what this worker has freed back to the system. Workers live on between tasks, beside each other, and else keep what
    they have used at most."""
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such function
        ctypes.CDLL(None).malloc_trim(0)
    pa.default_memory_pool().release_unused()


def free_name(name: str, *taken: Iterable[str]) -> str:
    """name, with as many _ behind it as make it differ from all column names taken, whatever their case."""
    used = {c.lower() for names in taken for c in names}
    while name.lower() in used:
        name += "_"
    return name


def bounded_broadcast(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Broadcast df only if its counted rows are few; else leave the join to Spark's shuffle."""
    return F.broadcast(df) if rows <= max_rows else df.hint("merge")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def remainder(key: Column, n: int) -> Column:
    """crc32(key as text) mod n; null for a null key."""
    return F.crc32(key.cast("string")) % n


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each; a longer text comes alone."""
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n or 0
    if start < len(sizes):
        yield batch.slice(start)
