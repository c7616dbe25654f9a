"""The physical plans that the pipeline relies on at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import raw

from txlake.operators import (
    avg_risk_score_by_region,
    curate,
    invalid_counts,
    profile_raw,
    top3_by_latest_sale_amount,
)
from txlake.plans import run_curate
from txlake.plans.jobs import read_curated, read_raw
from txlake.sources import Layout, write_partitions


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("lake")))
    rows = raw(spark, {}, {"processing_date": "2024-02-02"}, {"amount": "1"})
    write_partitions(rows, layout.raw, ["processing_date"])
    run_curate(spark, layout)
    return layout


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def shuffles(text):
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


def scans(text):
    return len(re.findall(r"^\(\d+\) Scan parquet", text, re.M))


def read_schema(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", text)[1]))


def test_region_average(spark, layout):
    text = plan(avg_risk_score_by_region(read_curated(spark, layout)))
    assert read_schema(text) == {"location_region", "risk_score"}
    assert "IsNotNull(risk_score)" in text and "Not(EqualTo(location_region,0))" in text
    assert "partial_avg" in text
    assert shuffles(text) == 2  # by region, then the sort of the few means


def test_top3_sends_one_row_per_task_and_address(spark, layout):
    text = plan(top3_by_latest_sale_amount(read_curated(spark, layout)))
    assert read_schema(text) == {"timestamp", "receiving_address", "amount", "transaction_type"}
    assert "EqualTo(transaction_type,sale)" in text
    kinds = re.findall(r"row_number\(\), 1, (\w+)|Exchange|TakeOrderedAndProject", text)
    assert {"Partial", "Final"} <= set(kinds)
    assert "TakeOrderedAndProject" in text
    assert shuffles(text) == 1


def test_profile_is_one_scan_and_one_wide_shuffle(spark, layout):
    text = plan(profile_raw(read_raw(spark, layout)))
    assert scans(text) == 1
    assert shuffles(text) == 2  # whole rows, then one row per task
    assert "partial_count" in text


def test_invalid_counts_do_not_shuffle_rows(spark, layout):
    text = plan(invalid_counts(read_raw(spark, layout)))
    assert scans(text) == 1
    assert shuffles(text) == 1
    assert "SinglePartition" in text


def test_curating_one_date_reads_only_its_directory(spark, layout):
    """A file that is not Parquet in another date's directory does no harm."""
    broken = Path(layout.raw, "processing_date=2024-02-02", "part-broken.parquet")
    broken.write_text("not a table")
    try:
        assert run_curate(spark, layout, ["2024-02-01"])["total_records"] == 2
        with pytest.raises(Exception, match="part-broken"):
            run_curate(spark, layout)
    finally:
        broken.unlink()


@pytest.mark.parametrize("read", [read_raw, read_curated])
def test_dates_prune_partitions(spark, layout, read):
    df = read(spark, layout)
    df = df.filter(F.col("processing_date").isin("2024-02-01"))
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan(df))[1]
    assert "2024-02-01" in filters or "19754" in filters  # as text, or in days


def test_curate_has_one_shuffle_and_no_python(spark, layout):
    text = plan(curate(read_raw(spark, layout)))
    assert shuffles(text) == 1
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert node not in text
