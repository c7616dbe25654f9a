from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from rows import raw

from txlake.operators import (
    avg_by_group,
    avg_risk_score_by_region,
    curate,
    latest_per_key,
    latest_sales,
    top3_by_latest_sale_amount,
    top_k,
)


def regions(spark, *pairs):
    rows = [
        {"location_region": region, "risk_score": score, "amount": str(i)}
        for i, (region, score) in enumerate(pairs)
    ]
    return [tuple(r) for r in avg_risk_score_by_region(curate(raw(spark, *rows))).collect()]


def sales(spark, *rows):
    fields = ("receiving_address", "timestamp", "amount", "transaction_type")
    return curate(raw(spark, *[dict(zip(fields, (*r, "sale")[:4], strict=True)) for r in rows]))


def test_region_filter(spark):
    pairs = [(r, "1") for r in ("0", " 0 ", "", "  ", None, "ASIA", " ASIA ", "00")]
    assert regions(spark, *pairs) == [("00", 1.0), ("ASIA", 1.0)]


def test_mean_is_rounded_half_up(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 1.5), ("c", 0.00005)], "k string, v double")
    got = {r.k: r.avg_v for r in avg_by_group(df, "k", "v", digits=0).collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 0.0}
    assert avg_by_group(df.filter("k = 'c'"), "k", "v").first().avg_v == 0.0001


def test_nan_counts_as_a_value_and_sorts_first(spark):
    got = regions(spark, ("A", "1"), ("A", "NaN"), ("B", "9"), ("C", "x"), ("C", "3"), ("D", "x"))
    assert got[0][0] == "A" and math.isnan(got[0][1])
    assert got[1:] == [("B", 9.0), ("C", 3.0)]


def test_equal_means_are_ordered_by_region(spark):
    got = regions(spark, ("Z", "5"), ("A", "5"), ("M", "7"))
    assert got == [("M", 7.0), ("A", 5.0), ("Z", 5.0)]


def test_latest_is_the_latest_valid_sale(spark):
    df = sales(
        spark,
        ("a", "100", "1"),
        ("a", "200", "x"),  # newer, but without an amount
        ("b", "100", "2"),
        ("b", "200", "9", "purchase"),  # newer, but not a sale
        ("b", "300", "9", "SALE"),
        ("c", "100", "3"),
        ("c", "100", "4"),  # the same second
        ("d", "x", "5"),
        ("", "100", "6"),
        ("  ", "100", "6"),
        (None, "100", "6"),
        ("e", "100", "NaN"),
        (" f ", "100", "7", " sale "),
    )
    got = {r.receiving_address: r.amount for r in latest_sales(df).collect()}
    assert math.isnan(got.pop("e"))
    assert got == {"a": 1.0, "b": 2.0, "c": 4.0, "f": 7.0}


def test_latest_spans_dates(spark):
    df = raw(
        spark,
        {"processing_date": "2024-02-02", "timestamp": "100", "amount": "1"},
        {"processing_date": "2024-02-01", "timestamp": "200", "amount": "2"},
    )
    assert [r.amount for r in latest_sales(curate(df)).collect()] == [2.0]


def test_top3_ties_and_short_tables(spark):
    df = sales(spark, *[(a, "100", n) for a, n in zip("dcbaz", "55519", strict=True)])
    got = [(r.receiving_address, r.amount) for r in top3_by_latest_sale_amount(df).collect()]
    assert got == [("z", 9.0), ("b", 5.0), ("c", 5.0)]
    short = sales(spark, ("a", "100", "1"), ("b", "100", "2"))
    assert [r.receiving_address for r in top3_by_latest_sale_amount(short).collect()] == ["b", "a"]
    assert top3_by_latest_sale_amount(short.filter("amount > 5")).collect() == []
    assert top3_by_latest_sale_amount(short).columns == ["receiving_address", "amount", "timestamp"]


def test_latest_per_key_keeps_other_columns(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, "old"), ("a", "x", 2, "new"), ("a", "y", 1, "only")],
        "k1 string, `k.2` string, t int, payload string",
    )
    got = latest_per_key(df, ["k1", "k.2"], [F.col("t").desc()])
    assert got.columns == df.columns
    assert {r.payload for r in got.collect()} == {"new", "only"}


def test_top_k(spark):
    assert [r.id for r in top_k(spark.range(100), [F.col("id").desc()], 2).collect()] == [99, 98]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_python(spark, seed):
    """Random rows, a third of them of one address: the same as a loop over them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        rows.append(
            {
                "receiving_address": rng.choice(["hot", f"a{rng.randint(0, 40)}", ""]),
                "timestamp": str(rng.randint(0, 300)),
                "amount": rng.choice(["x", str(rng.randint(0, 99))]),
                "transaction_type": rng.choice(["sale", " sale", "phishing"]),
                "location_region": rng.choice(["hot", "r1", "r2", "0", "", None]),
                "risk_score": rng.choice(["none", str(rng.randint(0, 100))]),
            }
        )
    curated = curate(raw(spark, *rows)).repartition(8)

    unique = {tuple(sorted(r.items(), key=str)): r for r in rows}.values()
    latest, scores = {}, defaultdict(list)
    for r in unique:
        sale = r["transaction_type"].strip() == "sale" and r["receiving_address"]
        if sale and r["amount"] != "x":
            new = (int(r["timestamp"]), float(r["amount"]))
            latest[r["receiving_address"]] = max(new, latest.get(r["receiving_address"], new))
        if r["location_region"] not in ("0", "", None) and r["risk_score"] != "none":
            scores[r["location_region"]].append(int(r["risk_score"]))

    top = sorted(((-amount, a, t) for a, (t, amount) in latest.items()))[:3]
    got = top3_by_latest_sale_amount(curated).withColumn("t", F.unix_seconds("timestamp")).collect()
    assert [(-r.amount, r.receiving_address, r.t) for r in got] == top

    means = {region: sum(s) / len(s) for region, s in scores.items()}
    got = {r.location_region: r.avg_risk_score for r in avg_risk_score_by_region(curated).collect()}
    assert got.keys() == means.keys()
    assert all(abs(got[k] - means[k]) <= 0.00005001 for k in means)
