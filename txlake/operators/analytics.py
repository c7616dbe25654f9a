"""The two analytic tables, and the general operators they are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.functions.names import (
    AMOUNT,
    LOCATION_REGION,
    PROCESSING_DATE,
    RECEIVING_ADDRESS,
    RISK_SCORE,
    TIMESTAMP,
    TRANSACTION_TYPE,
    column,
    quoted,
)
from txlake.functions.predicates import is_category, valid_address, valid_region

# The category that counts as a sale, and the size and rounding of outputs.
SALE = "sale"
TOP = 3
DIGITS = 4

_ROW_NUMBER = "__row_number"


def avg_by_group(
    df: DataFrame, key: str, value: str, name: str | None = None, digits: int = DIGITS
) -> DataFrame:
    """Mean of ``value`` per ``key``, rounded half up. Map-side partial sums absorb skew."""
    mean = F.round(F.avg(column(value)), digits)
    return df.groupBy(column(key)).agg(mean.alias(name or f"avg_{value}"))


def avg_risk_score_by_region(
    df: DataFrame, region: str = LOCATION_REGION, score: str = RISK_SCORE
) -> DataFrame:
    """Mean risk score of each valid region, highest first; equal means by region name.

    NaN is a value, not a missing one: it makes its region's mean NaN, which sorts first.
    """
    mean = f"avg_{score}"
    return (
        df.filter(valid_region(region) & column(score).isNotNull())
        .transform(avg_by_group, region, score, mean)
        .orderBy(column(mean).desc(), column(region))
    )


def region_sums(
    df: DataFrame,
    keys: Sequence[str] = (),
    region: str = LOCATION_REGION,
    score: str = RISK_SCORE,
) -> DataFrame:
    """What the mean of each valid region is made of: ``total`` and ``n``, also by ``keys``.

    Sums of parts can be added up, so days need not be read again.
    """
    return (
        df.filter(valid_region(region) & column(score).isNotNull())
        .groupBy(*[column(k) for k in keys], column(region))
        .agg(F.sum(column(score)).alias("total"), F.count(F.lit(1)).alias("n"))
    )


def avg_risk_from_sums(
    sums: DataFrame,
    region: str = LOCATION_REGION,
    name: str = f"avg_{RISK_SCORE}",
    digits: int = DIGITS,
) -> DataFrame:
    """``avg_risk_score_by_region`` from ``region_sums`` of all parts of a table."""
    mean = F.round(F.sum("total") / F.sum("n"), digits)
    return (
        sums.groupBy(column(region))
        .agg(mean.alias(name))
        .orderBy(column(name).desc(), column(region))
    )


def valid_sales(
    df: DataFrame,
    address: str = RECEIVING_ADDRESS,
    amount: str = AMOUNT,
    timestamp: str = TIMESTAMP,
    transaction_type: str = TRANSACTION_TYPE,
) -> DataFrame:
    """Sales with an address, an amount and a time."""
    return df.filter(
        is_category(transaction_type, SALE)
        & valid_address(address)
        & column(amount).isNotNull()
        & column(timestamp).isNotNull()
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each key to one row per task before it shuffles, so a key that holds
    much of the table sends no more than one row from each task.
    """
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order_by)
    return (
        df.withColumn(_ROW_NUMBER, F.row_number().over(window))
        .filter(F.col(_ROW_NUMBER) == 1)
        .drop(_ROW_NUMBER)
    )


def latest_sales(
    df: DataFrame,
    address: str = RECEIVING_ADDRESS,
    amount: str = AMOUNT,
    timestamp: str = TIMESTAMP,
    transaction_type: str = TRANSACTION_TYPE,
) -> DataFrame:
    """Address, amount and time of each address's latest valid sale.

    Of sales in the same second, the one with the larger amount counts as the latest.
    """
    return (
        df.transform(valid_sales, address, amount, timestamp, transaction_type)
        .select(column(address), column(amount), column(timestamp))
        .transform(latest_per_key, [address], [column(timestamp).desc(), column(amount).desc()])
    )


def daily_latest_sales(
    df: DataFrame,
    date: str = PROCESSING_DATE,
    address: str = RECEIVING_ADDRESS,
    amount: str = AMOUNT,
    timestamp: str = TIMESTAMP,
    transaction_type: str = TRANSACTION_TYPE,
) -> DataFrame:
    """``latest_sales`` of each date."""
    return (
        df.transform(valid_sales, address, amount, timestamp, transaction_type)
        .select(column(address), column(amount), column(timestamp), column(date))
        .transform(
            latest_per_key, [date, address], [column(timestamp).desc(), column(amount).desc()]
        )
    )


def merge_latest_sales(
    held: DataFrame,
    changed: DataFrame,
    address: str = RECEIVING_ADDRESS,
    amount: str = AMOUNT,
    timestamp: str = TIMESTAMP,
) -> DataFrame:
    """The later of two sales of each address; both frames have an address at most once.

    A join on the address: where ``held`` is bucketed by it, only ``changed`` is moved.
    """
    rest = [c for c in held.columns if c != address]
    old = held.select(column(address), F.struct(*[quoted(c) for c in rest]).alias("old"))
    new = changed.select(column(address), F.struct(*[quoted(c) for c in rest]).alias("new"))

    def order(side: str) -> Column:
        return F.struct(F.col(f"{side}.{quoted(timestamp)}"), F.col(f"{side}.{quoted(amount)}"))

    later = F.col("old").isNull() | (order("new") > order("old"))
    best = F.when(F.col("new").isNotNull() & later, F.col("new")).otherwise(F.col("old"))
    return (
        old.join(new, address, "full_outer")
        .select(column(address), best.alias("best"))
        .select(*[column(c) if c == address else F.col(f"best.{quoted(c)}") for c in held.columns])
    )


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in the given order; each task sends at most ``k`` rows."""
    return df.orderBy(*order_by).limit(k)


def top_sales(
    latest: DataFrame, address: str = RECEIVING_ADDRESS, amount: str = AMOUNT, k: int = TOP
) -> DataFrame:
    """The largest of the latest sales; equal amounts by address."""
    return latest.transform(top_k, [column(amount).desc(), column(address)], k)


def top3_by_latest_sale_amount(
    df: DataFrame,
    address: str = RECEIVING_ADDRESS,
    amount: str = AMOUNT,
    timestamp: str = TIMESTAMP,
    transaction_type: str = TRANSACTION_TYPE,
    k: int = TOP,
) -> DataFrame:
    """The addresses whose latest valid sale is largest; equal amounts by address."""
    return df.transform(latest_sales, address, amount, timestamp, transaction_type).transform(
        top_sales, address, amount, k
    )
