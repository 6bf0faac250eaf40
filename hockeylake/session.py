"""A Spark session with the settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "hockeylake", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling, and partition-wise overwrite."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    builder = SparkSession.builder.appName(name)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
