"""From a landed snapshot to raw rows: column names and the run date."""

from __future__ import annotations

from collections import defaultdict
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.names import PROCESSING_DATE


class ColumnCollisionError(ValueError):
    """Two headers have the same normalised name."""


def normalized_name(header: str) -> str:
    return header.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore the column names; fail if two become equal."""
    headers = defaultdict(list)
    for header in df.columns:
        headers[normalized_name(header)].append(header)
    clashes = {name: same for name, same in headers.items() if len(same) > 1}
    if clashes:
        raise ColumnCollisionError(f"headers with the same normalised name: {clashes}")
    return df.toDF(*headers)


def checked_date(run_date: str) -> str:
    """The run date as ``yyyy-MM-dd``; raises ``ValueError`` for anything that is no date."""
    return date.fromisoformat(run_date).isoformat()


def stamp_run_date(df: DataFrame, run_date: str, name: str = PROCESSING_DATE) -> DataFrame:
    """Add the run date as a ``yyyy-MM-dd`` string column."""
    return df.withColumn(name, F.lit(checked_date(run_date)))
