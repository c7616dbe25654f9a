"""Sketches: bounded, mergeable, and kept by date."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import raw

from txlake.operators import estimates, merge_sketches, sketch
from txlake.plans import run_curate
from txlake.plans.state import sketched_range, update_sketches
from txlake.sources import Layout, write_partitions

HALF = {"half": 0.5}
DAYS = ("2024-02-01", "2024-02-02", "2024-02-03")


def test_odd_values(spark):
    rows = [("a", 1.0, "x"), ("b", 2.0, "x"), ("", float("nan"), "x"), (None, None, "y")]
    made = sketch(spark.createDataFrame(rows, "d string, v double, k string"), "d", "v", ["k"])
    found = {r["k"]: r.asDict() for r in estimates(made, HALF).collect()}
    assert found["x"] == {"k": "x", "n": 3, "distinct_values": 2, "values": 2, "half": 1.0}
    assert found["y"] == {"k": "y", "n": 1, "distinct_values": 0, "values": 0, "half": None}
    none = estimates(merge_sketches(made.limit(0)), HALF).first().asDict()
    assert none == {"n": 0, "distinct_values": 0, "values": 0, "half": None}


def test_names_with_dots_and_repeated_rows(spark):
    df = spark.createDataFrame([("a", 3, 1)] * 50, "`d.1` string, `v 1` int, `k.k` int")
    made = estimates(sketch(df, "d.1", "v 1", ["k.k"]), {"least": 0.0, "half": 0.5})
    assert made.first() == (1, 50, 1, 50, 3.0, 3.0)


@pytest.mark.parametrize("parts", [1, 40])
def test_merged_parts_stay_within_the_error(spark, parts):
    """A hot part holds a third of the rows; sizes stay bounded, estimates near."""
    n = 600_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % parts).alias("part"),
        F.concat(F.lit("a"), F.col("id") % 90_000).alias("address"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("double").alias("value"),
    )
    made = sketch(rows, "address", "value", ["part"])
    longest = made.agg(F.max(F.length("distinct_sketch")), F.max(F.length("value_sketch"))).first()
    assert longest[0] < 17_000 and longest[1] < 64_000
    found = estimates(merge_sketches(made), {f"q{k}": k / 10 for k in range(1, 10)}).first()
    assert found["n"] == found["values"] == n
    assert abs(found["distinct_values"] - 90_000) <= 0.03 * 90_000
    for k in range(1, 10):
        assert abs(found[f"q{k}"] / 1_000_000 - k / 10) <= 0.02


def test_merging_in_any_order(spark):
    """The order may move an estimate, within the error."""
    ids = F.col("id")
    rows = spark.range(5000).select((ids % 7).alias("k"), ids.cast("string").alias("d"), F.rand(3).alias("v"))
    parts = sketch(rows, "d", "v", ["k"])
    for order in (F.col("k"), F.col("k").desc()):
        found = estimates(merge_sketches(parts.orderBy(order).coalesce(1)), HALF).first()
        assert (found["n"], found["values"]) == (5000, 5000)
        assert abs(found["distinct_values"] - 5000) <= 150 and abs(found["half"] - 0.5) <= 0.02


def day(date, addresses, score):
    return [
        {"processing_date": date, "receiving_address": f"a{k}", "risk_score": str(score), "timestamp": str(k)}
        for k in addresses
    ]


def test_ranges_of_dates(spark, base):
    layout = Layout(base)
    for date, addresses, score in zip(DAYS, (range(10), range(5, 20), range(30, 31)), (1, 2, 3), strict=True):
        write_partitions(raw(spark, *day(date, addresses, score)), layout.raw, ["processing_date"])
        run_curate(spark, layout, [date])
        update_sketches(spark, layout)

    def told(first, last):
        r = sketched_range(spark, layout, first, last, HALF).first()
        return r["n"], r["distinct_values"], r["values"], r["half"]

    assert told(DAYS[0], DAYS[0]) == (10, 10, 10, 1.0)
    assert told(DAYS[0], DAYS[1]) == (25, 20, 25, 2.0)
    assert told(DAYS[0], DAYS[2]) == (26, 21, 26, 2.0)
    assert told("2025-01-01", "2025-02-01") == (0, 0, 0, None)
    # A date that is curated again has another sketch; the others are not made again.
    kept = sorted(Path(layout.daily_sketches, f"processing_date={DAYS[0]}").glob("*.parquet"))
    write_partitions(raw(spark, *day(DAYS[1], range(2), 9)), layout.raw, ["processing_date"])
    run_curate(spark, layout, [DAYS[1]])
    update_sketches(spark, layout)
    assert told(DAYS[0], DAYS[1]) == (12, 10, 12, 1.0)
    assert sorted(Path(layout.daily_sketches, f"processing_date={DAYS[0]}").glob("*.parquet")) == kept


def test_a_range_reads_no_curated_row(spark, base):
    layout = Layout(base)
    write_partitions(raw(spark, *day(DAYS[0], range(4), 1)), layout.raw, ["processing_date"])
    run_curate(spark, layout)
    update_sketches(spark, layout)
    Path(layout.curated, f"processing_date={DAYS[0]}", "part-broken.parquet").write_text("no table")
    assert update_sketches(spark, layout).count() == 1
    assert sketched_range(spark, layout, DAYS[0], DAYS[0]).first()["distinct_values"] == 4


def test_nothing_curated(spark, base):
    layout = Layout(base)
    write_partitions(raw(spark, {"receiving_address": "", "risk_score": "x"}), layout.raw, ["processing_date"])
    run_curate(spark, layout)
    assert update_sketches(spark, layout).count() == 1
    found = sketched_range(spark, layout, "2000-01-01", "2100-01-01").first()
    assert found["distinct_values"] == 0 and found["values"] == 0 and found["risk_p50"] is None
    with pytest.raises(ValueError):
        sketched_range(spark, layout, "yesterday", DAYS[0])
