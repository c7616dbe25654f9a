"""Session for the command line. Library callers pass the session they have."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What Delta asks a session to be configured with.
_DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def get_spark(app_name: str, fmt: str = "parquet") -> SparkSession:
    """A UTC session; the master and resources come from ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if fmt == "delta":
        for key, value in _DELTA.items():
            builder = builder.config(key, value)
    return builder.getOrCreate()
