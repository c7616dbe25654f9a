"""Subtotals over all combinations of some columns, in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.names import column

LEVEL = "grouping_id"


def cube_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``total`` and ``n`` of ``value`` (not NULL) for every subset of ``keys``.

    ``grouping_id`` has a bit for each key, the first the highest, that is set where the row
    sums over that key; so a subtotal differs from the group whose key is NULL. Sums and
    counts of parts of a table can be added up by keys and ``grouping_id``.
    """
    return (
        df.filter(column(value).isNotNull())
        .cube(*[column(k) for k in keys])
        .agg(
            F.grouping_id().alias(LEVEL),
            F.sum(column(value)).alias("total"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def merge_cubes(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One cube from the rows of several."""
    return parts.groupBy(*[column(k) for k in keys], LEVEL).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
