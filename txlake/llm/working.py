"""Working tables: results that a later step reads again, kept in the shared folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from txlake.sources.files import remove
from txlake.sources.scratch import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back.

    This cuts the lineage: a lost executor costs tasks of the next step, not this one again.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_buckets(
    df: DataFrame, name: str, key: str, buckets: int, compression: str = "zstd"
) -> DataFrame:
    """Like ``stored``, hash-bucketed by ``key``: joins and groups on it move no row of it.

    Spark finds the buckets through its catalog, so the table ``txlake_<name>_<id>`` stays
    registered (as an external table) until someone drops it.
    """
    spark = df.sparkSession
    table = f"txlake_{name}_{uuid4().hex}"
    (
        df.write.format("parquet")
        .option("compression", compression)
        .option("path", f"{scratch_dir(spark)}/{name}")
        .bucketBy(buckets, key)
        .saveAsTable(table)
    )
    return spark.table(table)


def discard(*tables: DataFrame) -> None:
    """Delete working tables that no later step reads; they must come from ``stored``."""
    for df in tables:
        spark = df.sparkSession
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            remove(spark, path)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores behind it as it takes to differ from ``taken``."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python workers import it by name. A submitted application does the same with
    ``--py-files``; this serves sessions that were started some other way.
    """
    context = spark.sparkContext
    if getattr(context, "_txlake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="txlake-code-")) / "txlake_package.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted((root / "txlake").rglob("*.py")):
            packed.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    context._txlake_shipped = True
