from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from rows import raw

from txlake.operators import curate, trim_columns

NBSP = "\u00a0"


def test_types_and_pass_through(spark):
    df = curate(raw(spark, {"other column": " kept ", "a.b": "x"}, extra=("other column", "a.b")))
    assert dict(df.dtypes) == {
        "timestamp": "timestamp",
        "sending_address": "string",
        "receiving_address": "string",
        "amount": "double",
        "risk_score": "double",
        "transaction_type": "string",
        "location_region": "string",
        "processing_date": "date",
        "other column": "string",
        "a.b": "string",
    }
    row = df.first()
    assert row["other column"] == " kept "
    assert row["a.b"] == "x"
    assert row.processing_date == date(2024, 2, 1)


def test_dedup_is_exact_and_before_trimming(spark):
    df = raw(
        spark,
        {},
        {},  # a copy
        {"location_region": " ASIA"},  # differs by a space
        {"processing_date": "2024-02-02"},  # on another date
        {"amount": None},
        {"amount": None},  # a copy, with a NULL
        {"amount": "10.50"},  # the same number, another text
    )
    curated = curate(df)
    assert curated.count() == 5
    assert curated.filter(F.col("location_region") == "ASIA").count() == 5


def test_no_row_is_filtered_out(spark):
    bad = {
        "timestamp": "x",
        "amount": "x",
        "risk_score": "x",
        "location_region": None,
        "receiving_address": "",
    }
    row = curate(raw(spark, bad)).first()
    assert (row.timestamp, row.amount, row.risk_score, row.location_region) == (None,) * 4
    assert row.receiving_address == ""


def test_trim_strips_spaces_only(spark):
    texts = ["  a ", "\ta", NBSP + "a", "   ", ""]
    df = raw(spark, *[{"location_region": t, "amount": str(i)} for i, t in enumerate(texts)])
    got = [r.location_region for r in trim_columns(df).orderBy("amount").collect()]
    assert got == ["a", "\ta", NBSP + "a", "", ""]
