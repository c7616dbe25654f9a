from __future__ import annotations

import pytest

from txlake.operators import ColumnCollisionError, normalize_columns, stamp_run_date


def test_normalize(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["\t Location Region ", "AMOUNT", "a.b", "x\ty"])
    assert normalize_columns(df).columns == ["location_region", "amount", "a.b", "x\ty"]
    assert normalize_columns(df).first() == (1, 2, 3, 4)


def test_colliding_headers_are_named(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A B", "A_B", "c"])
    with pytest.raises(ColumnCollisionError, match="A B.*A_B"):
        normalize_columns(df)


def test_stamp(spark):
    df = stamp_run_date(spark.range(1), "2024-02-01")
    assert df.dtypes == [("id", "bigint"), ("processing_date", "string")]
    assert df.first().processing_date == "2024-02-01"


def test_stamp_refuses_what_is_no_date(spark):
    with pytest.raises(ValueError):
        stamp_run_date(spark.range(1), "yesterday")
