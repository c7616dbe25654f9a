"""Where working tables go: below a folder that every executor shares."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new directory URI below ``spark.checkpoint.dir``, else below the warehouse.

    Both are shared by all executors of a cluster; the rule is the same for every master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/txlake-{uuid4().hex}"
