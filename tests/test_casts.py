from __future__ import annotations

import math
import random
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from txlake.functions import epoch_to_timestamp, lenient_date, lenient_double, lenient_long

LONGS = {
    "12": 12,
    " 12 ": 12,
    "\t12\n": 12,
    "+5": 5,
    "12.7": 12,
    "12.": 12,
    "-3.9": -3,
    " 12.7 ": 12,
    "1649000000.9": 1649000000,
    "1.6e9": None,
    "1d": None,
    "0x10": None,
    "NaN": None,
    "Infinity": None,
    "none": None,
    "": None,
    "1,5": None,
    "1.2.3": None,
    "12.7x": None,
    "9223372036854775807": 2**63 - 1,
    "9223372036854775808": None,
    ".5": 0,
    ".": 0,
    " -.5 ": 0,
    None: None,
}

DOUBLES = {
    "12": 12.0,
    " 12 ": 12.0,
    "12.7": 12.7,
    "12.": 12.0,
    "1.6e9": 1.6e9,
    "1d": 1.0,
    "1f": 1.0,
    "0x10": None,
    "NaN": math.nan,
    "Infinity": math.inf,
    "1,5": None,
    "none": None,
    "": None,
    "9223372036854775808": 9223372036854775808.0,
    None: None,
}


def apply(spark, values, function, dtype):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    result = rows.select("i", function("v").alias("r")).orderBy("i").collect()
    return [r.r for r in result]


def test_long(any_session):
    got = apply(any_session, LONGS, lenient_long, "string")
    assert dict(zip(LONGS, got, strict=True)) == LONGS


def test_double(any_session):
    got = apply(any_session, DOUBLES, lenient_double, "string")
    for text, value, want in zip(DOUBLES, got, DOUBLES.values(), strict=True):
        assert value == want or (math.isnan(value) and math.isnan(want)), text


def test_date(any_session):
    values = {"2024-02-01": date(2024, 2, 1), "2024-02-30": None, "x": None, "": None, None: None}
    assert apply(any_session, values, lenient_date, "string") == list(values.values())


def test_epoch(any_session):
    values = {
        0: "1970-01-01T00:00:00",
        -1: "1969-12-31T23:59:59",
        1649000000: "2022-04-03T15:33:20",
        # Two instants with the same wall-clock time where summer time ends.
        1730611800: "2024-11-03T05:30:00",
        1730615400: "2024-11-03T06:30:00",
        2**63 - 1: None,
        -(2**63): None,
        None: None,
    }

    def seconds(c):
        return F.unix_seconds(epoch_to_timestamp(c))

    want = [
        text and int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp())
        for text in values.values()
    ]
    assert apply(any_session, values, seconds, "bigint") == want


def test_epoch_limits(spark):
    largest = (2**63 - 1) // 1_000_000
    rows = spark.createDataFrame([(largest,), (largest + 1,), (-largest,)], "s bigint")
    got = rows.select(F.unix_micros(epoch_to_timestamp("s")).alias("m")).collect()
    assert [r.m for r in got] == [largest * 1_000_000, None, -largest * 1_000_000]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_non_ansi_cast(spark, seed):
    """On random text: equal to the cast of a session without ANSI mode."""
    rng = random.Random(seed)
    alphabet = "0123456789" * 2 + "+-.. eEdfx\t"
    texts = sorted(
        {"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))) for _ in range(20000)}
    )
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", False)
    try:
        cast_long = apply(spark, texts, lambda c: F.col(c).cast("bigint"), "string")
        cast_double = apply(spark, texts, lambda c: F.col(c).cast("double"), "string")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)

    for text, got, want in zip(
        texts, apply(spark, texts, lenient_long, "string"), cast_long, strict=True
    ):
        assert got == want, repr(text)
    assert apply(spark, texts, lenient_double, "string") == cast_double
