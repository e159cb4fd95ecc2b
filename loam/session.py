"""Settings that the library expects of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what can be set on a running session; partition counts are left to the cluster and to adaptive planning."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
