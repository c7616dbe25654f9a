"""Data-quality counts and the report built from them.

The raw layer is profiled in one pass: equal rows are counted together
(``count_copies``), which gives the number of duplicates, and each check weighs a distinct
row by its number of copies. Copies are merged on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.names import (
    AMOUNT,
    LOCATION_REGION,
    RECEIVING_ADDRESS,
    RISK_SCORE,
    TIMESTAMP,
    column,
    quoted,
)
from txlake.functions.predicates import (
    invalid_address,
    invalid_double,
    invalid_long,
    invalid_region,
)
from txlake.operators.analytics import DIGITS, TOP

COPIES = "__copies"

# The output contracts stated in the report.
AVG_RISK_COLUMNS = ("location_region", "avg_risk_score")
TOP3_COLUMNS = ("receiving_address", "amount", "timestamp")

# Field names of the report's raw section.
TOTAL = "total_records"
DUPLICATES = "duplicate_records"
ERRORS = "total_error_records"
CONFORMITY = "conformity_percentage"
CHECK_FIELDS = (
    "invalid_amount_records",
    "invalid_risk_score_records",
    "invalid_timestamp_records",
    "invalid_location_region_records",
    "invalid_receiving_address_records",
)


def raw_checks(
    amount: str = AMOUNT,
    risk_score: str = RISK_SCORE,
    timestamp: str = TIMESTAMP,
    region: str = LOCATION_REGION,
    address: str = RECEIVING_ADDRESS,
) -> dict[str, Column]:
    """Report field -> predicate that is true for a raw row failing the check."""
    failed = (
        invalid_double(amount),
        invalid_double(risk_score),
        invalid_long(timestamp),
        invalid_region(region),
        invalid_address(address),
    )
    return dict(zip(CHECK_FIELDS, failed, strict=True))


def invalid_counts(df: DataFrame, checks: Mapping[str, Column] | None = None) -> DataFrame:
    """One row with the number of rows failing each check; one scan, no wide shuffle."""
    checks = checks or raw_checks()
    return df.agg(*[F.count_if(failed).alias(name) for name, failed in checks.items()])


def count_copies(df: DataFrame, name: str = COPIES) -> DataFrame:
    """The distinct rows of ``df``, each with its number of copies."""
    return df.groupBy(*[column(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def profile_columns(
    checks: Mapping[str, Column] | None = None,
    copies: str = COPIES,
    only: Column | None = None,
) -> list[Column]:
    """Aggregates over ``count_copies`` rows: total, duplicates and each failed check.

    ``only`` limits them to some rows. Each is a sum, so those of dates can be added up.
    """
    n = column(copies)
    checks = checks or raw_checks()

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c if only is None else F.when(only, c)), F.lit(0))

    return [
        total(n).alias(TOTAL),
        total(n - 1).alias(DUPLICATES),
        *[total(F.when(failed, n).otherwise(0)).alias(name) for name, failed in checks.items()],
    ]


def profile_raw(df: DataFrame, checks: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: total, duplicate and invalid counts of a raw table, in one pass."""
    return df.transform(count_copies).agg(*profile_columns(checks))


def with_conformity(profile: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Add the error total and the share of rows without an error, in per cent.

    A row that fails three checks counts three times, so the share can be negative.
    """
    total = column(TOTAL)
    errors = reduce(Column.__add__, [column(c) for c in profile.columns if c != TOTAL])
    share = F.round((total - column(ERRORS)) / total * 100, digits)
    return profile.withColumn(ERRORS, errors).withColumn(
        CONFORMITY, F.when(total > 0, share).otherwise(0.0)
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side in one row."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.agg(
        *[F.first(column(c), ignorenulls=True).alias(c) for c in merged.columns]
    )


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_totals(raw: DataFrame) -> DataFrame:
    """``layer_totals`` of a raw table and what ``curate`` keeps of it, in one pass."""
    n = column(COPIES)
    total, distinct = F.coalesce(F.sum(n), F.lit(0)), F.count(n)
    return count_copies(raw).agg(
        total.alias("raw_total_records"),
        distinct.alias("curated_total_records"),
        (total - distinct).alias("removed_records"),
    )


def layer_totals(raw: DataFrame, curated: DataFrame) -> DataFrame:
    """One row: rows in raw, rows in curated, and how many fewer the latter are."""
    totals = one_row(
        count_rows(raw, "raw_total_records"), count_rows(curated, "curated_total_records")
    )
    return totals.withColumn(
        "removed_records", F.col("raw_total_records") - F.col("curated_total_records")
    )


def output_checks(
    avg_risk: DataFrame | None,
    top3: DataFrame | None,
    avg_risk_exists: bool = True,
    top3_exists: bool = True,
) -> DataFrame:
    """One row with one struct per analytic table: is it there, and as it should be?

    A table that is not there is None: it does not exist, has no records, and nothing about
    it is as expected. ``is_ordered_desc`` states how the table is written; order is not
    kept by a table.
    """
    nothing = SparkSession.active().range(0).select()
    avg_risk_exists = avg_risk_exists and avg_risk is not None
    top3_exists = top3_exists and top3 is not None
    ordered, limited = avg_risk is not None, top3 is not None
    avg_risk = nothing if avg_risk is None else avg_risk
    top3 = nothing if top3 is None else top3
    records = F.count(F.lit(1))

    def columns_match(df: DataFrame, expected: Sequence[str]) -> Column:
        return F.lit(tuple(df.columns) == tuple(expected)).alias("columns_match")

    avg_checks = avg_risk.agg(
        F.struct(
            F.lit(avg_risk_exists).alias("path_exists"),
            records.alias("record_count"),
            F.lit(list(AVG_RISK_COLUMNS)).alias("expected_columns"),
            columns_match(avg_risk, AVG_RISK_COLUMNS),
            F.lit(ordered).alias("is_ordered_desc"),
        ).alias("avg_risk_score_by_region")
    )
    top3_checks = top3.agg(
        F.struct(
            F.lit(top3_exists).alias("path_exists"),
            records.alias("record_count"),
            F.lit(list(TOP3_COLUMNS)).alias("expected_columns"),
            columns_match(top3, TOP3_COLUMNS),
            (F.lit(limited) & (records <= TOP)).alias("has_expected_limit"),
        ).alias("top3_receiving_address_by_latest_sale_amount")
    )
    return one_row(avg_checks, top3_checks)


def build_report(
    run_date: str,
    profile: DataFrame,
    curated: DataFrame,
    outputs: DataFrame,
    landing_path: str,
    landing_exists: bool,
    known_curated: DataFrame | None = None,
) -> DataFrame:
    """The quality report as one nested row.

    ``profile`` comes from ``profile_raw`` and ``outputs`` from ``output_checks``. Rows of
    ``curated`` are counted; ``known_curated`` (``curated_records``) are counts of others.
    """
    raw = with_conformity(profile)
    counted = count_rows(curated, "curated_total")
    if known_curated is not None:
        counted = counted.union(known_curated.select("curated_records")).agg(
            F.sum("curated_total").alias("curated_total")
        )
    parts = one_row(
        raw.select(F.struct(*[quoted(c) for c in raw.columns]).alias("raw")),
        counted,
        outputs.select(F.struct(*[quoted(c) for c in outputs.columns]).alias("analytics")),
    )
    curated_total = F.col("curated_total")
    return parts.select(
        F.lit(run_date).alias("execution_date"),
        F.struct(
            F.lit(landing_exists).alias("file_exists"), F.lit(landing_path).alias("file_path")
        ).alias("landing"),
        "raw",
        F.struct(
            curated_total.alias(TOTAL),
            (F.col(f"raw.{TOTAL}") - curated_total).alias("removed_records"),
        ).alias("curated"),
        "analytics",
    )


def profile_frame(spark: SparkSession, profile: Mapping[str, int]) -> DataFrame:
    """A ``profile_raw`` row from counts that were observed while writing another table."""
    fields = [TOTAL, DUPLICATES, *raw_checks()]
    row = tuple(int(profile.get(name) or 0) for name in fields)
    return spark.createDataFrame([row], ", ".join(f"{name} bigint" for name in fields))
