"""A day's run reads a day's rows, and what it keeps equals a full rebuild."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from rows import raw

from txlake.operators import latest_sales, top3_by_latest_sale_amount
from txlake.plans import load_raw, run_avg_risk, run_curate, run_landing, run_pipeline, run_top3
from txlake.plans.jobs import raw_profile, read_curated, read_raw
from txlake.plans.state import (
    BUCKETS,
    merged_latest_sales,
    read_latest_sales,
    read_profiles,
    update_latest_sales,
    update_region_sums,
)
from txlake.sources import Layout, read_table, versions, write_partitions

HEADER = "timestamp,amount,risk_score,transaction_type,location_region,sending_address,receiving_address"
DAYS = ("2024-02-01", "2024-02-02", "2024-02-03")


def stored(df):
    return sorted(map(repr, df.collect()))


def source(base, *lines):
    path = Path(base, "source.csv")
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def random_lines(draw, n):
    return [
        f"{draw.choice([100, 200, 300, 'x'])},{draw.choice(['1', '2', '3.5', 'abc'])},{draw.randrange(5)},"
        f"{draw.choice(['sale', ' sale ', 'phishing'])},{draw.choice(['ASIA', 'EUROPE', '0', ''])},s,"
        f"{draw.choice(['a', 'b', 'c', 'd', ' ', ''])}"
        for _ in range(n)
    ]


def report(spark, layout):
    found = spark.read.json(layout.quality_report).first().asDict(recursive=True)
    return {k: v for k, v in found.items() if k != "landing"}


def outputs(spark, layout):
    return [
        stored(read_table(spark, layout.avg_risk_score_by_region)),
        stored(read_table(spark, layout.top3_receiving_address)),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_days_in_any_order_equal_a_rebuild(spark, base, seed):
    """First loads, repeats and corrections that lose rows, in a random order."""
    draw = random.Random(seed)
    layout = Layout(f"{base}/lake")
    for _ in range(6):
        day = draw.choice(DAYS)
        run_pipeline(spark, source(base, *random_lines(draw, 12)), layout.base, day)
    kept = [report(spark, layout), *outputs(spark, layout)]
    latest = stored(read_latest_sales(spark, layout).drop("processing_date"))
    curated = read_curated(spark, layout)
    assert latest == stored(latest_sales(curated))
    assert kept[2] == stored(top3_by_latest_sale_amount(curated))
    # Everything again, in another place, all dates at once.
    full = Layout(f"{base}/full")
    write_partitions(read_raw(spark, layout), full.raw, ["processing_date"])
    run_curate(spark, full)
    run_avg_risk(spark, full)
    run_top3(spark, full)
    assert outputs(spark, full) == kept[1:]
    assert stored(raw_profile(spark, full)) == stored(raw_profile(spark, layout))


def test_second_day_opens_no_file_of_the_first(spark, base):
    layout = run_pipeline(spark, source(base, "100,1,5,sale,ASIA,s,a"), f"{base}/lake", DAYS[0])
    for layer in (layout.raw, layout.curated):
        Path(layer, f"processing_date={DAYS[0]}", "part-broken.parquet").write_text("no table")
    run_pipeline(spark, source(base, "200,7,9,sale,ASIA,s,b"), layout.base, DAYS[1])
    found = report(spark, layout)
    assert found["raw"]["total_records"] == 2 and found["curated"]["total_records"] == 2
    assert outputs(spark, layout)[0] == ["Row(location_region='ASIA', avg_risk_score=7.0)"]
    with pytest.raises(Exception, match="part-broken"):
        read_curated(spark, layout).collect()


def test_a_date_loaded_but_not_curated_is_made_up_for(spark, base):
    layout = Layout(f"{base}/lake")
    run_pipeline(spark, source(base, "100,1,5,sale,ASIA,s,a"), layout.base, DAYS[0])
    run_landing(spark, source(base, "200,9,5,sale,ASIA,s,b", "200,9,5,sale,ASIA,s,b"), layout, DAYS[1])
    load_raw(spark, layout, DAYS[1])
    # The report counts its rows though no profile of it is stored.
    assert raw_profile(spark, layout).first()["duplicate_records"] == 1
    run_pipeline(spark, source(base, "300,4,5,sale,ASIA,s,c"), layout.base, DAYS[2])
    assert report(spark, layout)["raw"]["total_records"] == 4
    assert {r["receiving_address"] for r in read_latest_sales(spark, layout).collect()} == set("abc")


def test_one_profile_a_date(spark, base):
    layout = Layout(base)
    dates = [f"2024-03-{d:02d}" for d in range(1, 20)]  # more than are observed at once
    rows = [{"processing_date": d, "amount": str(k % 2)} for k, d in enumerate(dates * 3)]
    write_partitions(raw(spark, *rows, {"processing_date": None, "amount": "x"}), layout.raw, ["processing_date"])
    total = run_curate(spark, layout)
    held = {r["processing_date"]: r for r in read_profiles(spark, layout).collect()}
    assert set(held) == {*dates, None}
    assert all(held[d]["total_records"] == 3 and held[d]["duplicate_records"] == 1 for d in dates)
    assert held[None]["invalid_amount_records"] == 1 and held[None]["curated_records"] == 1
    assert total["total_records"] == 58 and total["curated_records"] == 39


def test_a_day_without_sales_is_not_read_again(spark, base):
    layout = Layout(base)
    write_partitions(raw(spark, {"transaction_type": "none", "location_region": ""}), layout.raw, ["processing_date"])
    run_curate(spark, layout)
    assert update_latest_sales(spark, layout).count() == 0
    assert update_region_sums(spark, layout).count() == 0
    before = versions(spark, layout.latest_sales)
    update_latest_sales(spark, layout)
    assert versions(spark, layout.latest_sales) == before


def test_merging_a_day_moves_only_that_day(spark, base):
    layout = Layout(base)
    for k, day in enumerate(DAYS):
        rows = [{"processing_date": day, "receiving_address": f"a{j}", "timestamp": str(k)} for j in range(k, 40)]
        write_partitions(raw(spark, *rows), layout.raw, ["processing_date"])
        run_curate(spark, layout, [day])
        if k == 2:
            break
        update_latest_sales(spark, layout)
    merged = merged_latest_sales(spark, layout, [DAYS[2]])
    text = merged._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "SortMergeJoin FullOuter" in text
    scans = re.findall(r"Location: \w+ ?\[(.*?)\]", text)
    assert len(scans) == 2
    assert f"processing_date={DAYS[2]}" in text and DAYS[0] not in text and DAYS[1] not in text
    assert "Bucketed: true" in text and f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in text
    # What moves is the day's: one row of a task and address, then one of each address.
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert stored(merged.select("receiving_address", "amount", "timestamp")) == stored(
        latest_sales(read_curated(spark, layout))
    )


def test_earlier_version_of_the_latest_sales(spark, base):
    layout = Layout(base)
    for day, amount in zip(DAYS, ("1", "2", "3")):
        rows = {"processing_date": day, "amount": amount, "timestamp": amount}
        write_partitions(raw(spark, rows), layout.raw, ["processing_date"])
        run_curate(spark, layout, [day])
        update_latest_sales(spark, layout)
    assert [read_latest_sales(spark, layout, back).first()["amount"] for back in (0, 1, 2)] == [3.0, 2.0, 1.0]
    # Another session finds the buckets again.
    for table in spark.catalog.listTables():
        if table.name.startswith("txlake_latest_sales_"):
            spark.sql(f"drop table {table.name}")
    assert read_latest_sales(spark, layout).first()["amount"] == 3.0


def test_header_only_day(spark, base):
    """As a first load it leaves readable tables; on a filled day what was there stays."""
    layout = run_pipeline(spark, source(base), f"{base}/lake", DAYS[0])
    assert read_raw(spark, layout).columns[-1] == "processing_date"
    assert read_raw(spark, layout).count() == read_curated(spark, layout).count() == 0
    assert report(spark, layout)["raw"]["conformity_percentage"] == 0
    run_pipeline(spark, source(base, "100,1,5,sale,ASIA,s,a"), layout.base, DAYS[0])
    run_pipeline(spark, source(base), layout.base, DAYS[0])
    run_pipeline(spark, source(base), layout.base, DAYS[1])
    assert read_curated(spark, layout).count() == 1
    assert report(spark, layout)["raw"]["total_records"] == 1
    assert len(outputs(spark, layout)[1]) == 1
