"""What users run: the command line, stage by stage, and the session it makes."""

from __future__ import annotations

from datetime import UTC, datetime

import pytest

from txlake import __main__ as command
from txlake.plans import get_spark, run_avg_risk, run_quality, run_top3, session
from txlake.sources import Layout, read_table, table_exists

HEADER = "Timestamp,Amount,Risk Score,Transaction Type,Location Region,Sending Address,Receiving Address"


@pytest.fixture
def lake(spark, tmp_path, monkeypatch):
    """Commands use, and would stop, a session; here it is that of the tests, which stays."""

    class Kept:
        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    used = []

    def session_of(name, fmt):
        used.append((name, fmt))
        return spark

    monkeypatch.setattr(command, "get_spark", session_of)
    monkeypatch.setattr(type(spark), "stop", lambda self: used.append("stopped"))
    source = tmp_path / "source.csv"
    source.write_text(f"{HEADER}\n100,10,50,sale,ASIA,s,a\n200,x,70,sale,0,s,b\n")
    return str(source), str(tmp_path / "lake"), used


def run(stage, base, *more):
    command.main([stage, "--base", base, "--run-date", "2024-02-01", *more])


def test_each_stage(spark, lake, capsys):
    source, base, used = lake
    layout = Layout(base)
    run("landing", base, "--source", source)
    assert table_exists(spark, layout.landing("2024-02-01"))
    run("raw", base)
    assert read_table(spark, layout.raw).count() == 2
    run("curated", base)
    assert read_table(spark, layout.curated).filter("amount is null").count() == 1
    run("curated", base, "--dates", "2024-02-01")
    run("curated", base, "--rebuild")
    assert read_table(spark, layout.curated).count() == 2
    capsys.readouterr()
    run("avg-risk", base)
    shown = capsys.readouterr().out
    assert "avg_risk_score" in shown and "ASIA" in shown and "50.0" in shown
    run("top3", base)
    shown = capsys.readouterr().out
    assert "receiving_address" in shown and "10.0" in shown and "|a " in shown
    run("quality", base)
    assert "execution_date" in capsys.readouterr().out
    assert spark.read.json(layout.quality_report).first()["raw"]["total_records"] == 2
    assert [u for u in used if u != "stopped"] == [
        (f"txlake-{s}", "parquet")
        for s in ("landing", "raw", "curated", "curated", "curated", "avg-risk", "top3", "quality")
    ]
    assert used.count("stopped") == 8


def test_whole_flow(spark, lake, capsys):
    source, base, used = lake
    run("pipeline", base, "--source", source)
    assert "ASIA" in capsys.readouterr().out
    assert spark.read.json(Layout(base).quality_report).first()["curated"]["total_records"] == 2
    assert used == [("txlake-pipeline", "parquet"), "stopped"]


def test_a_failed_stage_stops_its_session(lake):
    _, base, used = lake
    with pytest.raises(Exception):
        run("raw", base)
    assert used[-1] == "stopped"


def test_previews(spark, lake, capsys):
    source, base, _ = lake
    run("pipeline", base, "--source", source)
    layout = Layout(base)
    capsys.readouterr()
    for job in (run_avg_risk, run_top3):
        job(spark, layout)
        assert capsys.readouterr().out == ""
        job(spark, layout, preview=True)
        assert "+--" in capsys.readouterr().out
    run_quality(spark, layout, "2024-02-01", preview=True)
    assert "execution_date" in capsys.readouterr().out


def test_session_settings(spark, monkeypatch):
    """The builder is asked for UTC, and for Delta's classes only where Delta is meant."""
    asked = {}

    class Builder:
        def appName(self, name):
            asked["name"] = name
            return self

        def config(self, key, value):
            asked[key] = value
            return self

        def getOrCreate(self):
            return spark

    class Session:
        builder = Builder()

    monkeypatch.setattr(session, "SparkSession", Session)
    assert get_spark("x") is spark
    assert asked == {"name": "x", "spark.sql.session.timeZone": "UTC"}
    get_spark("y", "delta")
    assert {k for k in asked if "Delta" in str(asked[k])} == {
        "spark.sql.extensions",
        "spark.sql.catalog.spark_catalog",
    }
    assert not any("master" in k for k in asked)


def test_run_date_is_today_in_utc():
    assert command.parse(["raw", "--base", "b"]).run_date == datetime.now(UTC).date().isoformat()
