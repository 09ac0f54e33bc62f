"""Session settings the pipelines rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Adaptive execution with skew splitting, and UTC timestamps without zone."""
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
    }.items():
        spark.conf.set(key, value)
    return spark
