"""The whole flow: landing, raw, curated, the two analytic tables, the report."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from txlake.operators.ingest import checked_date
from txlake.plans.jobs import (
    curate_new,
    load_raw,
    run_avg_risk,
    run_curate,
    run_landing,
    run_quality,
    run_top3,
)
from txlake.sources.layout import Layout


def run_pipeline(
    spark: SparkSession,
    source: str,
    base: str,
    run_date: str,
    fmt: str = "parquet",
    dates: Sequence[str] | None = None,
    preview: bool = False,
    rebuild: bool = False,
) -> Layout:
    """Run every stage for one run date and return where the results are.

    The run date is curated, and so are dates that were loaded but not curated since; all
    else comes from what is kept by date and by address, so a day's run reads a day's rows.
    ``dates`` names the dates to curate instead, and ``rebuild`` curates all.
    """
    run_date = checked_date(run_date)
    if dates is not None and run_date not in {checked_date(d) for d in dates}:
        raise ValueError(f"dates must include the run date {run_date}")
    layout = Layout(base)
    run_landing(spark, source, layout, run_date)
    load_raw(spark, layout, run_date, fmt)
    if dates is None and not rebuild:
        curate_new(spark, layout, run_date, fmt)
    else:
        run_curate(spark, layout, None if rebuild else dates, fmt)

    # The two tables do not depend on each other: the tasks of one fill the gaps of the other.
    with ThreadPoolExecutor(max_workers=2) as pool:
        tables = [
            pool.submit(inheritable_thread_target(spark)(run), spark, layout, fmt, preview)
            for run in (run_avg_risk, run_top3)
        ]
    for table in tables:
        table.result()

    run_quality(spark, layout, run_date, fmt, preview=preview)
    return layout
