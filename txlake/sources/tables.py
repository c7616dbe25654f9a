"""Columnar tables: partitioned and whole-table sinks, scans, and presence checks.

``fmt`` is any Spark table format; ``"delta"`` works where Delta is installed. A table that
``write_partitions`` made keeps its schema in a file beside its partitions, so it can be
read before it has a row, and later writes are held against it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from txlake.functions.names import column, quoted
from txlake.sources.files import is_filled, names_in, read_text, remove, replace_text
from txlake.sources.versions import version_path

SCHEMA = "_schema.json"
#: Fixed value: the directory name that Spark gives a partition of NULL.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class SchemaDriftError(ValueError):
    """The data to write does not fit the columns of the stored table."""


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    partition_types: Mapping[str, str] | None = None,
    back: int = 0,
) -> DataFrame:
    """Read a table; ``partition_types`` fixes types that Parquet directories lose.

    Filters on a cast partition column still prune directories. Of a table with versions
    the current one is read, or the one ``back`` versions before it.
    """
    at = version_path(spark, path, back)
    schema = stored_schema(spark, at)
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(at)
    return df.withColumns(
        {
            name: column(name).try_cast(dtype)
            for name, dtype in (partition_types or {}).items()
            if df.schema[name].dataType.simpleString() != dtype
        }
    )


def read_partitions(
    spark: SparkSession,
    path: str,
    key: str,
    values: Sequence[str | None],
    fmt: str = "parquet",
) -> DataFrame:
    """Only the named partitions; no other directory is listed or opened.

    Values that the table does not have give no rows. The table must have a stored schema,
    as ``write_partitions`` leaves it.
    """
    schema = stored_schema(spark, path)
    if fmt != "parquet" or schema is None:
        wanted = reduce(
            Column.__or__,
            [column(key).cast("string").eqNullSafe(F.lit(v)) for v in values],
            F.lit(False),
        )
        return read_table(spark, path, fmt).filter(wanted)
    held = set(names_in(spark, path))
    names = [f"{key}={_NULL_PARTITION if v is None else v}" for v in values]
    wanted = [f"{path}/{name}" for name in names if name in held]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*wanted)


def partition_values(
    spark: SparkSession, path: str, key: str, fmt: str = "parquet"
) -> list[str | None]:
    """The values of a partition column, by directory names where the format has them."""
    if fmt == "parquet":
        found = [n.split("=", 1)[1] for n in names_in(spark, path) if n.startswith(f"{key}=")]
        return [None if v == _NULL_PARTITION else v for v in found]
    if not table_exists(spark, path):
        return []
    rows = read_table(spark, path, fmt).select(column(key).cast("string")).distinct().collect()
    return sorted((r[0] for r in rows), key=lambda v: (v is not None, v or ""))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if the directory at ``path`` is there and not empty.

    Asks the file system for one entry, whereas reading would first list every file.
    """
    return is_filled(spark, path)


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that ``write_partitions`` stored, partition columns last."""
    text = read_text(spark, f"{path}/{SCHEMA}")
    return StructType.fromJson(json.loads(text)) if text else None


def _known_schema(spark: SparkSession, path: str, fmt: str) -> StructType | None:
    """The stored schema, or that of the data where none was stored."""
    if not table_exists(spark, path):
        return None
    if (schema := stored_schema(spark, path)) is not None:
        return schema
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no data file in it
            return None
        raise


def reconcile(df: DataFrame, schema: StructType, path: str, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of a stored schema, in its order.

    A column that ``df`` lacks becomes NULL of the stored type. One that the table lacks, or
    whose type differs, is refused. Partition columns must be there; they are compared by
    name only, since directories hold them as text.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    stored = {f.name: f.dataType.simpleString() for f in schema}
    retyped = {n for n in types.keys() & stored.keys() - set(keys) if types[n] != stored[n]}
    if retyped or types.keys() - stored.keys() or set(keys) - types.keys():
        changed = sorted(retyped | types.keys() ^ stored.keys())
        raise SchemaDriftError(f"columns {changed} differ from the table at {path}")
    return df.select(
        *[
            column(f.name)
            if f.name in types
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _nullable(schema: StructType, keys: Sequence[str]) -> StructType:
    """All fields nullable, as files are read, and partition columns last."""
    ordered = [f for f in schema if f.name not in keys] + [schema[k] for k in keys]
    return StructType([StructField(f.name, f.dataType, True) for f in ordered])


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str],
    fmt: str = "parquet",
) -> None:
    """Replace just the partitions present in ``df``; all others stay.

    So an empty ``df`` replaces nothing; as a first write it leaves an empty table that can
    be read. ``reconcile`` says what becomes of missing, additional and retyped columns.
    The overwrite mode is an option of this write, so the session's setting does not
    matter. There is no repartition by key: one large date would then be one task.
    """
    keys = list(partition_by)
    spark = df.sparkSession
    schema = _known_schema(spark, path, fmt)
    if schema is not None:
        df = reconcile(df, schema, path, keys)
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .save(path)
    )
    if fmt == "parquet" and stored_schema(spark, path) is None:
        replace_text(spark, f"{path}/{SCHEMA}", _nullable(df.schema, keys).json())


def drop_partitions(
    spark: SparkSession, path: str, key: str, values: Iterable[str | None]
) -> None:
    """Remove partitions of a Parquet table; those it does not have are ignored."""
    for value in values:
        remove(spark, f"{path}/{key}={_NULL_PARTITION if value is None else value}")


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    """Gather rows of a key into few, evenly sized tasks before a partitioned write.

    Adaptive execution splits a large key into several tasks and joins small ones, so
    files are neither many per date nor one per date.
    """
    return df.hint("rebalance", *[F.col(quoted(k)) for k in keys])


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a whole, unpartitioned table."""
    df.write.format(fmt).mode("overwrite").save(path)


def write_json(df: DataFrame, path: str) -> None:
    """Write a report of a few rows as one JSON part file."""
    df.coalesce(1).write.mode("overwrite").json(path)
