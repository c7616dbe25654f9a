from __future__ import annotations

import pytest
from compare import assert_same

import __spark_entry__ as contract
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
WRITERS = {
    "csv_all_string_scan",
    "land_snapshot",
    "table_roundtrip",
    "dynamic_partition_overwrite",
    "full_overwrite",
    "raw_load",
    "curate_job_two_dates",
    "dq_missing_output",
    "dq_stored_layers",
    "empty_load",
    "incremental_two_days",
    "keyed_latest_sales",
    "narrow_load",
    "one_version_back",
    "sketched_ranges",
    "streamed_load",
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert assert_same(contract.queries()[name](spark, SF), contract.oracle_sql()[name], SF) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_query_in_any_session(any_session, name):
    assert_same(contract.queries()[name](any_session, SF), contract.oracle_sql()[name], SF)


def test_known_answers(spark):
    """Values that were worked out before the operators existed."""
    sf = "/root/testdata/sf0.01"
    queries = contract.queries()
    summary = queries["dq_summary"](spark, sf).first().asDict()
    assert summary == {
        "total_records": 10244,
        "duplicate_records": 244,
        "invalid_amount_records": 446,
        "invalid_risk_score_records": 540,
        "invalid_timestamp_records": 239,
        "invalid_location_region_records": 931,
        "invalid_receiving_address_records": 785,
        "total_error_records": 3185,
        "conformity_percentage": 68.9086,
    }
    assert [tuple(r) for r in queries["avg_risk_score_by_region"](spark, sf).collect()] == [
        ("ASIA", 50.6611),
        ("AFRICA", 50.0029),
        ("EUROPE", 49.9199),
        ("AMERICA", 49.4765),
        ("MIDDLE EAST", 49.2216),
    ]
    assert [tuple(r) for r in queries["top3_latest_sale_amount"](spark, sf).collect()] == [
        ("addr-60", 229.77, 1706428141),
        ("addr-88", 225.69, 1706278163),
        ("addr-79", 216.19, 1706322503),
    ]
