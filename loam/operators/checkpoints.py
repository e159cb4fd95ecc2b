"""Lineage is cut in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it. Without one only a local master, whose executors are this
    process, may use its own temporary folder; a cluster must name one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not where and not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (where or os.path.join(tempfile.gettempdir(), "loam-checkpoints")).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder of the session."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
