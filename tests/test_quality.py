from __future__ import annotations

import random

import pytest
from rows import raw

from txlake.operators import (
    avg_risk_score_by_region,
    build_report,
    curate,
    invalid_counts,
    layer_totals,
    output_checks,
    profile_raw,
    top3_by_latest_sale_amount,
    with_conformity,
)


def summary(df):
    return with_conformity(profile_raw(df)).first().asDict()


def test_empty_table(spark):
    row = summary(raw(spark, {}).limit(0))
    assert set(row.values()) == {0}
    assert invalid_counts(raw(spark, {}).limit(0)).first() == (0, 0, 0, 0, 0)


def test_a_row_counts_once_for_every_failed_check(spark):
    bad = {"amount": "x", "risk_score": None, "timestamp": "1e9"}
    row = summary(raw(spark, bad))
    assert row["total_error_records"] == 3
    assert row["conformity_percentage"] == -200.0


def test_copies_count_as_duplicates_and_in_every_check(spark):
    bad = {"amount": "x"}
    row = summary(raw(spark, bad, bad, bad, {}))
    assert row["total_records"] == 4
    assert row["duplicate_records"] == 2
    assert row["invalid_amount_records"] == 3
    assert row["total_error_records"] == 5
    assert row["conformity_percentage"] == -25.0


def test_region_and_address_are_judged_as_raw_text(spark):
    regions = ["0", " 0 ", "  ", None, "", "ASIA", "\t"]
    row = summary(raw(spark, *[{"location_region": r} for r in regions]))
    assert row["invalid_location_region_records"] == 4
    row = summary(raw(spark, *[{"receiving_address": a} for a in ["", "  ", None, "a", "0"]]))
    assert row["invalid_receiving_address_records"] == 3


def test_nan_is_valid(spark):
    row = summary(raw(spark, {"amount": "NaN", "risk_score": "Infinity"}))
    assert row["total_error_records"] == 0
    assert row["conformity_percentage"] == 100.0


@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass_equals_separate_counts(spark, seed):
    """Random rows with NULLs, a third of them copies of one row."""
    rng = random.Random(seed)
    pools = {
        "amount": ["1", "x", None],
        "risk_score": ["1", "", " 2 "],
        "timestamp": ["1", "1.5", "x"],
        "location_region": ["A", "0", " ", None],
        "receiving_address": ["a", " ", None],
    }
    rows = [
        {} if rng.random() < 0.33 else {k: rng.choice(v) for k, v in pools.items()}
        for _ in range(2000)
    ]
    df = raw(spark, *rows).repartition(8)
    row = summary(df)
    assert row["total_records"] == df.count()
    assert row["duplicate_records"] == df.count() - df.distinct().count()
    for name, count in invalid_counts(df).first().asDict().items():
        assert row[name] == count
    assert layer_totals(df, curate(df)).first().asDict() == {
        "raw_total_records": df.count(),
        "curated_total_records": df.distinct().count(),
        "removed_records": row["duplicate_records"],
    }


def test_report_layout(spark):
    df = raw(spark, {}, {}, {"location_region": "EUROPE", "receiving_address": "q"})
    curated = curate(df)
    outputs = output_checks(
        avg_risk_score_by_region(curated), top3_by_latest_sale_amount(curated), True, False
    )
    report = build_report("2024-02-01", profile_raw(df), curated, outputs, "/landing", True)
    assert report.count() == 1
    assert report.first().asDict(recursive=True) == {
        "execution_date": "2024-02-01",
        "landing": {"file_exists": True, "file_path": "/landing"},
        "raw": {
            "total_records": 3,
            "duplicate_records": 1,
            "invalid_amount_records": 0,
            "invalid_risk_score_records": 0,
            "invalid_timestamp_records": 0,
            "invalid_location_region_records": 0,
            "invalid_receiving_address_records": 0,
            "total_error_records": 1,
            "conformity_percentage": 66.6667,
        },
        "curated": {"total_records": 2, "removed_records": 1},
        "analytics": {
            "avg_risk_score_by_region": {
                "path_exists": True,
                "record_count": 2,
                "expected_columns": ["location_region", "avg_risk_score"],
                "columns_match": True,
                "is_ordered_desc": True,
            },
            "top3_receiving_address_by_latest_sale_amount": {
                "path_exists": False,
                "record_count": 2,
                "expected_columns": ["receiving_address", "amount", "timestamp"],
                "columns_match": True,
                "has_expected_limit": True,
            },
        },
    }


def test_output_checks_see_wrong_tables(spark):
    wrong = spark.range(4).selectExpr("id as x")
    row = output_checks(wrong, wrong).first()
    assert not row.avg_risk_score_by_region.columns_match
    assert not row.top3_receiving_address_by_latest_sale_amount.has_expected_limit
