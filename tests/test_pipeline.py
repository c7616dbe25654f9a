from __future__ import annotations

from pathlib import Path

import pytest
from pyspark import TaskContext
from pyspark.sql import Observation
from rows import RAW_COLUMNS, raw

from checks.scratch import scratch_dir
from txlake.__main__ import parse
from txlake.operators import count_copies, curate
from txlake.operators.quality import COPIES, profile_columns
from txlake.plans import load_raw, run_curate, run_landing, run_pipeline, run_quality
from txlake.plans.jobs import read_curated, read_raw
from txlake.sources import Layout, read_table, rebalance, write_partitions

HEADER = (
    "Timestamp,Amount,Risk Score,Transaction Type,Location Region,"
    "Sending Address,Receiving Address,Note"
)
DAY_1 = [
    "100,10,50,sale,ASIA,s,a,x",
    "100,10,50,sale,ASIA,s,a,x",
    "200,20,70, sale , ASIA ,s,b,y",
    "300,abc,10,sale,0,s,c,z",
]
DAY_2 = ["400,5,30,sale,EUROPE,s,a,x", "100,10,50,sale,ASIA,s,a,x"]


@pytest.fixture
def source(tmp_path):
    def write(lines):
        path = tmp_path / "source.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


def stored(df):
    return sorted(map(repr, df.collect()))


def report(spark, layout):
    return spark.read.json(layout.quality_report).first().asDict(recursive=True)


def averages(spark, layout):
    rows = read_table(spark, layout.avg_risk_score_by_region).collect()
    return {r.location_region: r.avg_risk_score for r in rows}


def receivers(spark, layout):
    rows = read_table(spark, layout.top3_receiving_address).collect()
    return {r.receiving_address: r.amount for r in rows}


def test_two_days(spark, source, base):
    layout = run_pipeline(spark, source(DAY_1), f"{base}/lake", "2024-02-01")
    assert averages(spark, layout) == {"ASIA": 60.0}
    assert receivers(spark, layout) == {"a": 10.0, "b": 20.0}
    first = report(spark, layout)
    assert first["landing"]["file_exists"]
    assert first["raw"]["total_records"] == 4
    assert first["raw"]["duplicate_records"] == 1
    assert first["raw"]["conformity_percentage"] == 25.0
    assert first["curated"] == {"total_records": 3, "removed_records": 1}

    # The next day repeats a row of the first: it counts again in the mean, not in the top.
    run_pipeline(spark, source(DAY_2), f"{base}/lake", "2024-02-02")
    assert averages(spark, layout) == {"ASIA": 56.6667, "EUROPE": 30.0}
    assert receivers(spark, layout) == {"a": 5.0, "b": 20.0}
    second = report(spark, layout)
    assert second["execution_date"] == "2024-02-02"
    assert second["raw"]["total_records"] == 6
    assert second["raw"]["duplicate_records"] == 1
    assert read_raw(spark, layout).columns[-2:] == ["note", "processing_date"]


def test_rerun_of_a_day_changes_nothing(spark, source, base):
    layout = run_pipeline(spark, source(DAY_1), f"{base}/lake", "2024-02-01")
    run_pipeline(spark, source(DAY_2), f"{base}/lake", "2024-02-02")
    before = [stored(read_raw(spark, layout)), stored(read_curated(spark, layout))]
    run_pipeline(spark, source(DAY_2), f"{base}/lake", "2024-02-02")
    assert [stored(read_raw(spark, layout)), stored(read_curated(spark, layout))] == before


def test_curating_one_date_equals_curating_all(spark, source, base):
    full, daily = f"{base}/full", f"{base}/daily"
    for lines, day in ((DAY_1, "2024-02-01"), (DAY_2, "2024-02-02")):
        all_dates = run_pipeline(spark, source(lines), full, day)
        one_date = run_pipeline(spark, source(lines), daily, day, dates=[day])
    assert stored(read_curated(spark, one_date)) == stored(read_curated(spark, all_dates))
    got, want = report(spark, one_date), report(spark, all_dates)
    assert got.pop("landing")["file_exists"] and want.pop("landing")["file_exists"]
    assert got == want


def test_observed_profile_equals_a_pass_over_raw(spark, base):
    layout = Layout(base)
    bad = {"amount": "x", "location_region": " "}
    df = raw(spark, {}, {}, bad, bad, bad, {"processing_date": "2024-02-02"})
    write_partitions(df, layout.raw, ["processing_date"])
    profile = run_curate(spark, layout)
    assert stored(read_curated(spark, layout)) == stored(
        curate(df).select(read_curated(spark, layout).columns)
    )
    for path in (layout.avg_risk_score_by_region, layout.top3_receiving_address):
        spark.range(1).write.parquet(path)
    reports = []
    for given in (profile, None):
        run_quality(spark, layout, "2024-02-01", profile=given)
        reports.append(report(spark, layout))
    assert reports[0] == reports[1]
    assert reports[0]["raw"]["duplicate_records"] == 3
    assert not reports[0]["landing"]["file_exists"]


def test_observed_profile_counts_retried_tasks_once(spark, base):
    """Every task of the write fails at the end of its first attempt."""

    def fail_once(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    rows = raw(spark, *[{"amount": str(i % 700)} for i in range(1000)]).repartition(8)
    distinct = rebalance(count_copies(rows), "processing_date")
    profile = Observation()
    observed = distinct.observe(profile, *profile_columns()).drop(COPIES)
    observed.mapInPandas(fail_once, observed.schema).write.parquet(f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 700
    assert profile.get["total_records"] == 1000
    assert profile.get["duplicate_records"] == 300


def test_curating_a_date_without_rows(spark, base):
    layout = Layout(base)
    write_partitions(raw(spark, {}), layout.raw, ["processing_date"])
    run_curate(spark, layout)
    for wrong in ("1999-01-01", "2024-13-45", "2024/02/01"):
        with pytest.raises(ValueError):
            run_curate(spark, layout, [wrong])
    assert read_curated(spark, layout).count() == 1


def test_stages_alone(spark, source, base):
    layout = Layout(base)
    run_landing(spark, source(DAY_1), layout, "2024-02-01")
    load_raw(spark, layout, "2024-02-01")
    assert set(dict(read_raw(spark, layout).dtypes).values()) == {"string"}
    assert set(RAW_COLUMNS) <= set(read_raw(spark, layout).columns)


def test_operators_leave_the_session_as_it_is(spark, source, base):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll
    run_pipeline(spark, source(DAY_1), f"{base}/lake", "2024-02-01")
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll) == before


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first != second
    assert Path(first).parent == Path(shared) == Path(second).parent


def test_command_line(capsys):
    args = parse(["curated", "--base", "/b", "--dates", "2024-02-01", "2024-02-02"])
    assert args.dates == ["2024-02-01", "2024-02-02"]
    assert len(args.run_date) == 10
    with pytest.raises(SystemExit):
        parse(["landing", "--base", "/b"])
    assert "--source" in capsys.readouterr().err
