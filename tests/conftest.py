from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8,3]")  # tasks may fail twice
        .appName("txlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(
    params=[(False, "UTC"), (True, "America/New_York"), (False, "America/New_York")],
    ids=["legacy-utc", "ansi-dst", "legacy-dst"],
)
def any_session(spark, request):
    """The session under other settings than its own (ANSI mode on, UTC)."""
    ansi, zone = request.param
    before = {
        key: spark.conf.get(key)
        for key in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")
    }
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    spark.conf.set("spark.sql.session.timeZone", zone)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)
