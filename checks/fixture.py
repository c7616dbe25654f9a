"""Transactions derived from the ``events`` and ``region`` tables (FIXTURES.md section 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DATE = "2024-02-01"
NEXT_DATE = "2024-02-02"

# The columns of the driver's tables; declared, so that no job infers them.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
REGION = "r_regionkey int, r_name string"

# Header texts as a source file might have them; they normalise to the raw names.
HEADERS = {
    "timestamp": "Timestamp",
    "sending_address": "Sending Address",
    "receiving_address": " Receiving Address ",
    "amount": "AMOUNT",
    "risk_score": "Risk Score",
    "transaction_type": "Transaction Type",
    "location_region": "Location Region",
}


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def transactions_raw(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """All-string raw rows with every kind of bad value, and every 41st row twice.

    The rows are repeated by ``explode``, so ``events`` is scanned once. ``ts`` has no time
    zone, and neither has the epoch made from it.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    region = spark.read.schema(REGION).parquet(f"{sf_dir}/region.parquet")
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    sender = F.concat(F.lit("s-"), (F.col("event_id") % 97).cast("string"))
    rows = (
        events.join(region, F.col("r_regionkey") == F.col("event_id") % 5)
        .select(
            "event_id",
            F.when(_every(43), "not-a-time").otherwise(epoch.cast("string")).alias("timestamp"),
            F.when(_every(11), F.concat(F.lit(" "), sender))
            .otherwise(sender)
            .alias("sending_address"),
            F.when(_every(17), "  ")
            .when(_every(53), None)
            .otherwise(F.concat(F.lit("addr-"), F.col("user_id").cast("string")))
            .alias("receiving_address"),
            F.when(_every(23), "abc").otherwise(F.col("value").cast("string")).alias("amount"),
            F.when(_every(19), "none")
            .otherwise(F.regexp_extract("props", "([0-9]+)", 1))
            .alias("risk_score"),
            F.when(F.col("event_type") == "purchase", " sale ")
            .otherwise(F.col("event_type"))
            .alias("transaction_type"),
            F.when(_every(29), "0")
            .when(_every(31), "")
            .when(_every(37), None)
            .when(_every(7), F.concat(F.lit(" "), "r_name", F.lit(" ")))
            .otherwise(F.col("r_name"))
            .alias("location_region"),
            F.lit(RUN_DATE).alias("processing_date"),
        )
    )
    if copies:
        times = F.when(_every(41), 2).otherwise(1)
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).drop("copy")
    return rows.drop("event_id")


def source_frame(raw: DataFrame) -> DataFrame:
    """The rows as they come from a source: without a run date, with source headers."""
    return raw.drop("processing_date").withColumnsRenamed(HEADERS)


def two_dates(raw: DataFrame) -> DataFrame:
    """The same rows under two processing dates."""
    dates = F.array(F.lit(RUN_DATE), F.lit(NEXT_DATE))
    return raw.withColumn("processing_date", F.explode(dates))


# The same rows for DuckDB, as a CTE that oracle queries start with.
RAW_SQL = """
with base as (
  select event_id,
    case when event_id % 43 = 0 then 'not-a-time'
         else cast(cast(floor(epoch(ts)) as bigint) as varchar) end as "timestamp",
    case when event_id % 11 = 0 then concat(' s-', cast(event_id % 97 as varchar))
         else concat('s-', cast(event_id % 97 as varchar)) end as sending_address,
    case when event_id % 17 = 0 then '  ' when event_id % 53 = 0 then null
         else concat('addr-', cast(user_id as varchar)) end as receiving_address,
    case when event_id % 23 = 0 then 'abc' else cast(value as varchar) end as amount,
    case when event_id % 19 = 0 then 'none'
         else regexp_extract(props, '([0-9]+)', 1) end as risk_score,
    case when event_type = 'purchase' then ' sale ' else event_type end as transaction_type,
    case when event_id % 29 = 0 then '0' when event_id % 31 = 0 then ''
         when event_id % 37 = 0 then null
         when event_id % 7 = 0 then concat(' ', r_name, ' ') else r_name end as location_region,
    '2024-02-01' as processing_date
  from events join region on r_regionkey = event_id % 5
),
raw as (
  select * exclude (event_id) from base
  union all
  select * exclude (event_id) from base where event_id % 41 = 0
)
"""
