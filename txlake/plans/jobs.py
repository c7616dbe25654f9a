"""One function per stage. Stages hand over through tables, so each can be run alone."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txlake.functions.casts import lenient_date
from txlake.functions.names import PROCESSING_DATE
from txlake.operators.analytics import avg_risk_from_sums, top_sales
from txlake.operators.curate import trim_columns, type_columns
from txlake.operators.ingest import checked_date, normalize_columns, stamp_run_date
from txlake.operators.quality import (
    AVG_RISK_COLUMNS,
    COPIES,
    TOP3_COLUMNS,
    build_report,
    count_copies,
    output_checks,
    profile_columns,
    profile_frame,
    profile_raw,
)
from txlake.plans.state import (
    CURATED_RECORDS,
    PROFILE_FIELDS,
    Dates,
    added_profiles,
    forget_curated,
    forget_raw,
    profiled_dates,
    read_profiles,
    update_latest_sales,
    update_region_sums,
    write_profiles,
)
from txlake.sources.csv_files import land_snapshot, read_csv_strings
from txlake.sources.layout import Layout
from txlake.sources.tables import (
    partition_values,
    read_partitions,
    read_table,
    rebalance,
    table_exists,
    write_json,
    write_partitions,
)
from txlake.sources.versions import publish_table

#: Dates that one job curates, at most.
DATES_AT_ONCE = 8


def read_raw(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, layout.raw, fmt, {PROCESSING_DATE: "string"})


def _raw_rows(
    spark: SparkSession, layout: Layout, dates: Dates, fmt: str
) -> DataFrame:
    """Raw rows of some dates, with the run date as a date; no other date is opened.

    For grouping whole rows, where text would widen the key. Run dates are all written in
    one format, so equal dates are equal texts.
    """
    rows = read_partitions(spark, layout.raw, PROCESSING_DATE, dates, fmt)
    return rows.withColumn(PROCESSING_DATE, lenient_date(PROCESSING_DATE))


def read_curated(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, layout.curated, fmt, {PROCESSING_DATE: "date"})


def run_landing(spark: SparkSession, source: str, layout: Layout, run_date: str) -> None:
    """Source CSV -> the run date's landing directory."""
    land_snapshot(spark, source, layout.landing(run_date))


def load_raw(
    spark: SparkSession, layout: Layout, run_date: str, fmt: str = "parquet"
) -> None:
    """Landing directory -> the run date's partition of the raw table.

    A landing without rows replaces nothing: what the date had stays, as with any dynamic
    overwrite. Columns that the landing lacks become NULL.
    """
    raw = (
        read_csv_strings(spark, layout.landing(run_date))
        .transform(normalize_columns)
        .transform(stamp_run_date, run_date)
    )
    forget_raw(spark, layout, [checked_date(run_date)])
    write_partitions(raw, layout.raw, [PROCESSING_DATE], fmt)


def run_curate(
    spark: SparkSession,
    layout: Layout,
    dates: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Raw table -> curated table; returns the quality profile of the raw rows read.

    ``dates`` limits the run to some dates; each must be a date that the raw table has, else
    ``ValueError`` is raised before anything is written. The result is the same as that of a full run,
    because rows of different dates are never duplicates of each other.

    Deduplicating whole rows is the most expensive step of the pipeline, and the quality
    profile needs the same grouping. So the profile of each date is observed on the
    deduplicated rows while they are written, and stored. The observation sits after the
    last shuffle, where Spark counts each task once even if it is retried. Some dates at a
    time are curated together, which bounds what is observed at once.
    """
    held = partition_values(spark, layout.raw, PROCESSING_DATE, fmt)
    wanted: list[str | None] = held
    if dates is not None:
        wanted = sorted({checked_date(d) for d in dates})
        if missing := sorted(set(wanted) - set(held)):
            raise ValueError(f"the raw table has no rows of {missing}")
    chunks = [wanted[k : k + DATES_AT_ONCE] for k in range(0, len(wanted), DATES_AT_ONCE)]
    profiles = {}
    for chunk in chunks or [[]]:
        profiles |= _curate_dates(spark, layout, chunk, fmt)
    return added_profiles(profiles.values())


def _curate_dates(
    spark: SparkSession, layout: Layout, dates: Dates, fmt: str
) -> dict[str | None, dict[str, int]]:
    """Curate some dates in one job; the profile of each, which is stored as well."""
    distinct = count_copies(_raw_rows(spark, layout, dates, fmt))
    if len(dates) > 1:
        distinct = rebalance(distinct, PROCESSING_DATE)
    observed = [
        c.alias(f"{k} {name}")
        for k, date in enumerate(dates)
        for own in [F.col(PROCESSING_DATE).eqNullSafe(F.lit(date).cast("date"))]
        for c, name in zip(
            [*profile_columns(only=own), F.count_if(own)], PROFILE_FIELDS, strict=True
        )
    ]
    profile = Observation()
    if observed:
        distinct = distinct.observe(profile, *observed)
    forget_curated(spark, layout, dates)
    curated = distinct.drop(COPIES).transform(type_columns).transform(trim_columns)
    write_partitions(curated, layout.curated, [PROCESSING_DATE], fmt)
    if not observed:
        return {}
    found = profile.get
    profiles = {
        date: {name: found.get(f"{k} {name}") or 0 for name in PROFILE_FIELDS}
        for k, date in enumerate(dates)
    }
    write_profiles(spark, layout, profiles)
    return profiles


def curate_new(
    spark: SparkSession, layout: Layout, run_date: str, fmt: str = "parquet"
) -> dict[str, int]:
    """Curate the run date, and dates whose raw rows came since they were last curated."""
    held = partition_values(spark, layout.raw, PROCESSING_DATE, fmt)
    done = set(profiled_dates(spark, layout)) - {checked_date(run_date)}
    return run_curate(spark, layout, [d for d in held if d is not None and d not in done], fmt)


def run_avg_risk(
    spark: SparkSession, layout: Layout, fmt: str = "parquet", preview: bool = False
) -> None:
    """Curated table -> mean risk score by region; reads dates that have no sums yet."""
    result = avg_risk_from_sums(update_region_sums(spark, layout, fmt))
    publish_table(result, layout.avg_risk_score_by_region, fmt, _has(AVG_RISK_COLUMNS))
    if preview:
        saved = read_table(spark, layout.avg_risk_score_by_region, fmt)
        saved.orderBy(F.desc("avg_risk_score"), "location_region").show(truncate=False)


def run_top3(
    spark: SparkSession, layout: Layout, fmt: str = "parquet", preview: bool = False
) -> None:
    """Curated table -> top three receivers by the amount of their latest sale.

    Reads dates that are not in the latest sales yet, and the latest sales.
    """
    latest = update_latest_sales(spark, layout, fmt)
    result = top_sales(latest).select(*TOP3_COLUMNS)
    publish_table(result, layout.top3_receiving_address, fmt, _has(TOP3_COLUMNS))
    if preview:
        saved = read_table(spark, layout.top3_receiving_address, fmt)
        saved.orderBy(F.desc("amount"), "receiving_address").show(truncate=False)


def _has(columns: Sequence[str]) -> Callable[[DataFrame], bool]:
    return lambda written: tuple(written.columns) == tuple(columns)


def _output(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    return read_table(spark, path, fmt) if table_exists(spark, path) else None


def raw_profile(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> DataFrame:
    """The profile of the whole raw table, from those stored by date.

    Dates without one, whose rows came after they were curated, are profiled here.
    """
    done = profiled_dates(spark, layout)
    held = partition_values(spark, layout.raw, PROCESSING_DATE, fmt)
    known = read_partitions(
        spark, layout.raw_profiles, PROCESSING_DATE, [d for d in done if d in held]
    ) if done else read_profiles(spark, layout)
    fields = [n for n in PROFILE_FIELDS if n != CURATED_RECORDS]
    parts = known.select(*fields)
    if fresh := [d for d in held if d not in done]:
        parts = parts.union(profile_raw(_raw_rows(spark, layout, fresh, fmt)).select(*fields))
    return parts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in fields])


def run_quality(
    spark: SparkSession,
    layout: Layout,
    run_date: str,
    fmt: str = "parquet",
    profile: Mapping[str, int] | None = None,
    preview: bool = False,
) -> None:
    """All layers -> the quality report.

    The raw section adds up the profiles that were stored by date, unless a ``profile`` of
    the whole table is given. Curated rows are known from the profiles, too; only dates
    without one are counted. Outputs that are not there are reported, not read.
    """
    total = raw_profile(spark, layout, fmt) if profile is None else profile_frame(spark, profile)
    outputs = output_checks(
        _output(spark, layout.avg_risk_score_by_region, fmt),
        _output(spark, layout.top3_receiving_address, fmt),
    )
    run_date = checked_date(run_date)
    landing = layout.landing(run_date)
    curated = partition_values(spark, layout.curated, PROCESSING_DATE, fmt)
    done = [d for d in profiled_dates(spark, layout) if d in curated]
    known = read_profiles(spark, layout)
    if done:
        known = read_partitions(spark, layout.raw_profiles, PROCESSING_DATE, done)
    report = build_report(
        run_date,
        total,
        read_partitions(
            spark, layout.curated, PROCESSING_DATE, [d for d in curated if d not in done], fmt
        ),
        outputs,
        landing,
        table_exists(spark, landing),
        known,
    )
    write_json(report, layout.quality_report)
    if preview:
        spark.read.json(layout.quality_report).show(truncate=False, vertical=True)
