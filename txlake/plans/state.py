"""State kept between runs, so that a day's run reads a day's rows.

* By date: the profile of raw rows (written by the job that curates them), sums by region,
  sketches of addresses and risk scores, and each address's latest sale of that date. A date's part is removed before the rows it
  was made from are replaced, and whoever needs it makes the missing parts.
* By key: each address's latest sale of all dates, in versions that are bucketed by address.
  The sales of a date are merged into it by a join that moves only that date's.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.casts import lenient_date
from txlake.functions.names import (
    AMOUNT,
    LOCATION_REGION,
    PROCESSING_DATE,
    RECEIVING_ADDRESS,
    RISK_SCORE,
    TIMESTAMP,
    quoted,
)
from txlake.functions.predicates import valid_address
from txlake.operators.analytics import (
    daily_latest_sales,
    latest_per_key,
    merge_latest_sales,
    region_sums,
    valid_sales,
)
from txlake.operators.ingest import checked_date
from txlake.operators.quality import CHECK_FIELDS, DUPLICATES, TOTAL
from txlake.operators.sketches import estimates, merge_sketches, sketch
from txlake.sources.layout import Layout
from txlake.sources.tables import (
    drop_partitions,
    partition_values,
    read_partitions,
    read_table,
    table_exists,
    write_partitions,
)
from txlake.sources.versions import current_version, publish, version_path

CURATED_RECORDS = "curated_records"
#: Quantiles of the risk score that are told of a range of dates.
RISK_QUANTILES = {"risk_p25": 0.25, "risk_p50": 0.5, "risk_p75": 0.75, "risk_p95": 0.95}
PROFILE_FIELDS = (TOTAL, DUPLICATES, *CHECK_FIELDS, CURATED_RECORDS)

#: Files of a version of the latest sales; a version keeps the number it was written with.
BUCKETS = 64

Dates = Sequence[str | None]


def forget_raw(spark: SparkSession, layout: Layout, dates: Dates) -> None:
    """Raw rows of these dates are about to change."""
    drop_partitions(spark, layout.raw_profiles, PROCESSING_DATE, dates)


def forget_curated(spark: SparkSession, layout: Layout, dates: Dates) -> None:
    """Curated rows of these dates are about to change."""
    for path in (
        layout.raw_profiles,
        layout.region_sums,
        layout.daily_latest_sales,
        layout.daily_sketches,
    ):
        drop_partitions(spark, path, PROCESSING_DATE, dates)


def write_profiles(
    spark: SparkSession, layout: Layout, profiles: Mapping[str | None, Mapping[str, int]]
) -> None:
    """One row for each date: the counts that were observed while it was curated."""
    rows = [
        (*(int(counts.get(name) or 0) for name in PROFILE_FIELDS), date)
        for date, counts in profiles.items()
    ]
    fields = ", ".join(f"{name} bigint" for name in PROFILE_FIELDS)
    df = spark.createDataFrame(rows, f"{fields}, {PROCESSING_DATE} string")
    write_partitions(df.coalesce(1), layout.raw_profiles, [PROCESSING_DATE])


def profiled_dates(spark: SparkSession, layout: Layout) -> list[str | None]:
    return partition_values(spark, layout.raw_profiles, PROCESSING_DATE)


def read_profiles(spark: SparkSession, layout: Layout) -> DataFrame:
    """All profiles, a row a date; without rows where nothing was curated yet."""
    if not table_exists(spark, layout.raw_profiles):
        fields = ", ".join(f"{name} bigint" for name in PROFILE_FIELDS)
        return spark.createDataFrame([], f"{fields}, {PROCESSING_DATE} string")
    return read_table(spark, layout.raw_profiles)


def _missing(spark: SparkSession, layout: Layout, path: str, fmt: str) -> list[str | None]:
    done = set(partition_values(spark, path, PROCESSING_DATE))
    return [
        d for d in partition_values(spark, layout.curated, PROCESSING_DATE, fmt) if d not in done
    ]


def _curated(spark: SparkSession, layout: Layout, dates: Dates, fmt: str) -> DataFrame:
    rows = read_partitions(spark, layout.curated, PROCESSING_DATE, dates, fmt)
    return rows.withColumn(PROCESSING_DATE, lenient_date(PROCESSING_DATE))


def _with_marks(df: DataFrame, dates: Dates) -> DataFrame:
    """``df`` and a row of NULLs for each date, so that a date without rows is known."""
    spark = df.sparkSession
    marks = spark.createDataFrame([(d,) for d in dates], f"{PROCESSING_DATE} string").select(
        *[
            lenient_date(PROCESSING_DATE).alias(f.name)
            if f.name == PROCESSING_DATE
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.schema
        ]
    )
    return df.union(marks)


def _write_part(df: DataFrame, path: str, dates: Dates) -> None:
    """A few files: what is kept of a date has one row for each of its keys."""
    write_partitions(
        _with_marks(df, dates).hint("rebalance", F.col(PROCESSING_DATE)), path, [PROCESSING_DATE]
    )


def update_region_sums(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> DataFrame:
    """Sums by region of all dates; only dates without sums are read from the curated table."""
    dates = _missing(spark, layout, layout.region_sums, fmt)
    if dates or not table_exists(spark, layout.region_sums):
        sums = region_sums(_curated(spark, layout, dates, fmt), [PROCESSING_DATE])
        _write_part(
            sums.select(LOCATION_REGION, "total", "n", PROCESSING_DATE), layout.region_sums, dates
        )
    return read_table(spark, layout.region_sums).filter("n > 0")


def update_sketches(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> DataFrame:
    """Sketches of all dates; only dates without them are read from the curated table.

    They tell the different valid receiving addresses, and the quantiles of the risk score.
    """
    dates = _missing(spark, layout, layout.daily_sketches, fmt)
    if dates or not table_exists(spark, layout.daily_sketches):
        address = F.when(valid_address(RECEIVING_ADDRESS), F.col(RECEIVING_ADDRESS))
        made = sketch(
            _curated(spark, layout, dates, fmt), address, RISK_SCORE, [PROCESSING_DATE]
        )
        _write_part(
            made.select(*[c for c in made.columns if c != PROCESSING_DATE], PROCESSING_DATE),
            layout.daily_sketches,
            dates,
        )
    return read_table(spark, layout.daily_sketches).filter("n > 0")


def sketched_range(
    spark: SparkSession,
    layout: Layout,
    first: str,
    last: str,
    quantiles: Mapping[str, float] = RISK_QUANTILES,
) -> DataFrame:
    """One row on the dates from ``first`` to ``last``, from their stored sketches alone.

    ``distinct_values`` estimates the receiving addresses, ``values`` counts the risk scores,
    ``n`` the curated rows. Rows without a run date are in no range.
    """
    first, last = checked_date(first), checked_date(last)
    held = partition_values(spark, layout.daily_sketches, PROCESSING_DATE)
    dates = [d for d in held if d is not None and first <= d <= last]
    parts = read_partitions(spark, layout.daily_sketches, PROCESSING_DATE, dates)
    return merge_sketches(parts.filter("n > 0")).transform(estimates, quantiles)


def _state_table(path: str, version: str) -> str:
    return f"txlake_latest_sales_{zlib.crc32(path.encode()):08x}_{version.replace('-', '_')}"


def read_latest_sales(spark: SparkSession, layout: Layout, back: int = 0) -> DataFrame | None:
    """Each address's latest sale: the current version, or ``back`` versions before it.

    The buckets are known to the session's catalog, where the version is registered if need
    be. None if there is no version yet.
    """
    path = layout.latest_sales
    if current_version(spark, path) is None:
        return None
    at = version_path(spark, path, back)
    return _registered(spark, path, at)


def _registered(spark: SparkSession, path: str, at: str) -> DataFrame:
    table = _state_table(path, at.rsplit("/", 1)[1])
    if not spark.catalog.tableExists(table):
        spark.sql(
            f"""
            create table {table} ({quoted(RECEIVING_ADDRESS)} string, {quoted(AMOUNT)} double,
                {quoted(TIMESTAMP)} timestamp, {quoted(PROCESSING_DATE)} date)
            using parquet options (path '{at}')
            clustered by ({quoted(RECEIVING_ADDRESS)}) into {BUCKETS} buckets
            """
        )
    return spark.table(table)


def merged_latest_sales(
    spark: SparkSession, layout: Layout, dates: Dates, fmt: str = "parquet"
) -> DataFrame:
    """The next version of the latest sales: the current one with ``dates`` read again.

    What the version has from other dates stays valid. Addresses whose latest sale was of
    one of ``dates`` may have to fall back to a sale of another date; those addresses, if
    there are any, are looked up in the latest sales by date. Sales of earlier dates
    themselves are not read.
    """
    day = (
        valid_sales(_curated(spark, layout, dates, fmt))
        .select(RECEIVING_ADDRESS, AMOUNT, TIMESTAMP, PROCESSING_DATE)
        .transform(_latest)
    )
    held = read_latest_sales(spark, layout)
    if held is None:
        return day
    replaced = F.coalesce(
        F.date_format(PROCESSING_DATE, "yyyy-MM-dd").isin(*[d for d in dates if d]), F.lit(False)
    ) | (F.col(PROCESSING_DATE).isNull() & F.lit(None in dates))
    stale = held.filter(replaced).select(RECEIVING_ADDRESS)
    if not stale.isEmpty():
        others = [
            d
            for d in partition_values(spark, layout.daily_latest_sales, PROCESSING_DATE)
            if d not in dates
        ]
        earlier = (
            read_partitions(spark, layout.daily_latest_sales, PROCESSING_DATE, others)
            .withColumn(PROCESSING_DATE, lenient_date(PROCESSING_DATE))
            .join(stale, RECEIVING_ADDRESS, "left_semi")
            .select(day.columns)
        )
        day = day.union(earlier).transform(_latest)
    return merge_latest_sales(held.filter(~replaced), day)


def _latest(df: DataFrame) -> DataFrame:
    order = [F.col(c).desc() for c in (TIMESTAMP, AMOUNT)]
    return df.transform(latest_per_key, [RECEIVING_ADDRESS], order)


def update_latest_sales(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> DataFrame:
    """Merge all dates that are not in the latest sales yet; the current version.

    The version is published before the parts by date: a run that dies in between merges
    the same dates again, which changes nothing.
    """
    dates = _missing(spark, layout, layout.daily_latest_sales, fmt)
    held = read_latest_sales(spark, layout)
    if held is not None and not dates:
        return held
    merged = merged_latest_sales(spark, layout, dates, fmt)

    def write(target: str) -> None:
        (
            merged.write.format("parquet")
            .bucketBy(BUCKETS, RECEIVING_ADDRESS)
            .option("path", target)
            .saveAsTable(_state_table(layout.latest_sales, target.rsplit("/", 1)[1]))
        )

    publish(spark, layout.latest_sales, write)
    daily = daily_latest_sales(_curated(spark, layout, dates, fmt))
    _write_part(daily, layout.daily_latest_sales, dates)
    return read_latest_sales(spark, layout)


def added_profiles(parts: Iterable[Mapping[str, int]]) -> dict[str, int]:
    total = dict.fromkeys(PROFILE_FIELDS, 0)
    for part in parts:
        for name in total:
            total[name] += part.get(name) or 0
    return total
