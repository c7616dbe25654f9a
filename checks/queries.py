"""Every operator of the pipeline as a query over the driver's tables.

Times leave the queries as epoch seconds (or without a zone), so that results do not
depend on the session's time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import NEXT_DATE, RUN_DATE, source_frame, transactions_raw, two_dates
from checks.scratch import scratch_dir
from txlake.functions import (
    epoch_to_timestamp,
    lenient_date,
    lenient_double,
    is_category,
    lenient_long,
    valid_address,
    valid_region,
)
from txlake.operators import (
    SALE,
    asof_join,
    avg_by_group,
    avg_risk_score_by_region,
    count_copies,
    cube_sums,
    curate,
    exact_dedup,
    invalid_counts,
    latest_sales,
    layer_totals,
    merge_cubes,
    distinct_totals,
    normalize_columns,
    output_checks,
    profile_raw,
    stamp_run_date,
    top3_by_latest_sale_amount,
    trim_columns,
    with_conformity,
    within_join,
)
from txlake.plans import load_raw, run_curate, run_landing, run_pipeline, run_quality
from txlake.plans.jobs import read_curated, read_raw
from txlake.plans.state import RISK_QUANTILES, sketched_range, update_latest_sales, update_sketches
from txlake.sources import (
    Layout,
    VersionError,
    drop_partitions,
    land_snapshot,
    overwrite_table,
    publish_table,
    read_csv_strings,
    read_table,
    write_csv_strings,
    write_partitions,
)
from txlake.streaming import ingest_new_files

THREE_DATES = (RUN_DATE, NEXT_DATE, "2024-02-03")

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def epoch_seconds(df: DataFrame, name: str = "timestamp") -> DataFrame:
    return df.withColumn(name, F.unix_seconds(name))


def without_zone(seconds: Column) -> Column:
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, origin)


def source_csv(spark: SparkSession, sf_dir: str, scratch: str) -> str:
    path = f"{scratch}/source"
    write_csv_strings(source_frame(transactions_raw(spark, sf_dir)), path)
    return path


# Sources and sinks


@query("csv_all_string_scan")
def csv_all_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/csv"
    write_csv_strings(transactions_raw(spark, sf_dir), path)
    return read_csv_strings(spark, path)


@query("land_snapshot")
def land_snapshot_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_dir(spark)
    landed = Layout(scratch).landing(RUN_DATE)
    land_snapshot(spark, source_csv(spark, sf_dir, scratch), landed)
    return read_csv_strings(spark, landed)


@query("table_roundtrip")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/table"
    write_partitions(two_dates(transactions_raw(spark, sf_dir)), path, ["processing_date"])
    return read_table(spark, path, partition_types={"processing_date": "string"})


@query("dynamic_partition_overwrite")
def dynamic_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two dates, then only the sales of the first: the second must stay."""
    path = f"{scratch_dir(spark)}/table"
    raw = transactions_raw(spark, sf_dir)
    write_partitions(two_dates(raw), path, ["processing_date"])
    write_partitions(raw.filter(F.col("transaction_type") == " sale "), path, ["processing_date"])
    return read_table(spark, path, partition_types={"processing_date": "string"})


@query("full_overwrite")
def full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all rows, then only the sales: nothing of the first write may stay."""
    path = f"{scratch_dir(spark)}/table"
    raw = transactions_raw(spark, sf_dir)
    overwrite_table(raw, path)
    overwrite_table(raw.filter(F.col("transaction_type") == " sale "), path)
    return read_table(spark, path)


# Projections


@query("normalize_columns")
def normalize_columns_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_frame(transactions_raw(spark, sf_dir)).transform(normalize_columns)


@query("stamp_processing_date")
def stamp_processing_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions_raw(spark, sf_dir).drop("processing_date")
    return rows.transform(stamp_run_date, NEXT_DATE)


@query("cast_double")
def cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).select(
        F.col("amount").alias("amount_text"),
        lenient_double("amount").alias("amount"),
        F.col("risk_score").alias("risk_score_text"),
        lenient_double("risk_score").alias("risk_score"),
    )


@query("cast_long")
def cast_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch texts, some with a fraction or padding."""
    text = F.col("timestamp")
    varied = (
        F.when(text.endswith("7"), F.concat(text, F.lit(".9")))
        .when(text.endswith("3"), F.concat(text, F.lit(".")))
        .when(text.endswith("1"), F.concat(F.lit("  "), text, F.lit(" ")))
        .otherwise(text)
    )
    return (
        transactions_raw(spark, sf_dir)
        .select(varied.alias("text"))
        .withColumn("seconds", lenient_long("text"))
    )


@query("epoch_to_timestamp")
def epoch_to_timestamp_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).select(
        F.col("timestamp").alias("text"),
        without_zone(F.unix_seconds(epoch_to_timestamp(lenient_long("timestamp")))).alias(
            "utc_time"
        ),
    )


@query("trim_columns")
def trim_columns_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).transform(trim_columns)


@query("cast_date")
def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = F.when(F.col("amount") == "abc", "undated").otherwise(F.col("processing_date"))
    return (
        two_dates(transactions_raw(spark, sf_dir))
        .select(dated.alias("text"))
        .withColumn("processing_date", lenient_date("text"))
    )


@query("curate_transactions")
def curate_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).transform(curate).transform(epoch_seconds)


# Filters


@query("valid_region_filter")
def valid_region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions_raw(spark, sf_dir).transform(trim_columns)
    return rows.filter(valid_region("location_region"))


@query("sale_filter")
def sale_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions_raw(spark, sf_dir).transform(trim_columns)
    return rows.filter(is_category("transaction_type", SALE))


# Aggregation, window, top-k


@query("exact_dedup")
def exact_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).transform(exact_dedup)


@query("avg_by_region_unsorted")
def avg_by_region_unsorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = transactions_raw(spark, sf_dir).transform(curate)
    return curated.transform(avg_by_group, "location_region", "risk_score")


@query("avg_risk_score_by_region")
def avg_risk_score_by_region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = transactions_raw(spark, sf_dir).transform(curate)
    return curated.transform(avg_risk_score_by_region)


@query("latest_sale_per_address")
def latest_sale_per_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = transactions_raw(spark, sf_dir).transform(curate)
    return curated.transform(latest_sales).transform(epoch_seconds)


@query("top3_latest_sale_amount")
def top3_latest_sale_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = transactions_raw(spark, sf_dir).transform(curate)
    return curated.transform(top3_by_latest_sale_amount).transform(epoch_seconds)


# Joins on time, subtotals


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = transactions_raw(spark, sf_dir).transform(curate).transform(epoch_seconds)
    return curated.filter("timestamp is not null")


@query("previous_transaction")
def previous_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sale with its receiver's last earlier transaction that has an amount."""
    rows = _timed(spark, sf_dir)
    sales = rows.filter(is_category("transaction_type", SALE) & valid_address("receiving_address"))
    seen = rows.filter("amount is not null")
    return asof_join(
        sales.select("receiving_address", "timestamp", "amount", "sending_address"),
        seen.select("receiving_address", "timestamp", "amount"),
        "receiving_address",
        "timestamp",
    )


@query("within_an_hour")
def within_an_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different transactions of a region, the later within an hour."""
    rows = _timed(spark, sf_dir).filter(valid_region("location_region"))
    rows = rows.select("location_region", "timestamp", "receiving_address", "amount")
    pairs = within_join(rows, rows, "location_region", "timestamp", 3600)
    return pairs.filter("next_timestamp > timestamp")


@query("risk_cube")
def risk_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk by region, type and date, with all subtotals, from the cubes of two dates."""
    keys = ["location_region", "transaction_type", "processing_date"]
    rows = two_dates(transactions_raw(spark, sf_dir)).transform(curate)
    parts = [
        cube_sums(rows.filter(F.col("processing_date") == F.lit(d)), keys, "risk_score")
        for d in (RUN_DATE, NEXT_DATE)
    ]
    return merge_cubes(parts[0].union(parts[1]), keys)


# Data quality


@query("dq_counts")
def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).transform(invalid_counts)


@query("dq_duplicates")
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often rows occur: the number of distinct rows with one copy, two copies, ..."""
    return (
        transactions_raw(spark, sf_dir)
        .transform(count_copies, "copies")
        .groupBy("copies")
        .agg(F.count(F.lit(1)).alias("distinct_rows"))
    )


@query("dq_summary")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(spark, sf_dir).transform(profile_raw).transform(with_conformity)


@query("dq_layer_reconciliation")
def dq_layer_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transactions_raw(spark, sf_dir)
    return distinct_totals(raw)


@query("dq_stored_layers")
def dq_stored_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw against a stored curated table that still has a date which raw lost."""
    layout = Layout(scratch_dir(spark))
    write_partitions(
        two_dates(transactions_raw(spark, sf_dir)), layout.raw, ["processing_date"]
    )
    run_curate(spark, layout)
    drop_partitions(spark, layout.raw, "processing_date", [NEXT_DATE])
    return layer_totals(read_raw(spark, layout), read_curated(spark, layout))


@query("dq_output_checks")
def dq_output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = transactions_raw(spark, sf_dir).transform(curate)
    checked = output_checks(
        curated.transform(avg_risk_score_by_region),
        curated.transform(top3_by_latest_sale_amount),
    )
    return checked.select(*flat_outputs(""))


@query("dq_mismatched_outputs")
def dq_mismatched_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs that are not as expected: a renamed column, and more rows than there may be."""
    curated = transactions_raw(spark, sf_dir).transform(curate)
    checked = output_checks(
        curated.transform(avg_by_group, "location_region", "risk_score", "mean"),
        curated.transform(latest_sales),
    )
    return checked.select(*flat_outputs(""))


def flat_outputs(prefix: str) -> list[Column]:
    avg, top3 = (
        f"{prefix}avg_risk_score_by_region",
        f"{prefix}top3_receiving_address_by_latest_sale_amount",
    )
    return [
        F.col(f"{avg}.path_exists").alias("avg_path_exists"),
        F.col(f"{avg}.record_count").alias("avg_record_count"),
        F.concat_ws(",", f"{avg}.expected_columns").alias("avg_expected_columns"),
        F.col(f"{avg}.columns_match").alias("avg_columns_match"),
        F.col(f"{avg}.is_ordered_desc").alias("avg_is_ordered_desc"),
        F.col(f"{top3}.path_exists").alias("top3_path_exists"),
        F.col(f"{top3}.record_count").alias("top3_record_count"),
        F.concat_ws(",", f"{top3}.expected_columns").alias("top3_expected_columns"),
        F.col(f"{top3}.columns_match").alias("top3_columns_match"),
        F.col(f"{top3}.has_expected_limit").alias("top3_has_expected_limit"),
    ]


# Jobs


@query("raw_load")
def raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_dir(spark)
    layout = Layout(scratch)
    run_landing(spark, source_csv(spark, sf_dir, scratch), layout, RUN_DATE)
    load_raw(spark, layout, RUN_DATE)
    return read_raw(spark, layout)


@query("streamed_load")
def streamed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after two triggers over new files, and a third that finds none."""
    scratch = scratch_dir(spark)
    layout = Layout(scratch)
    path = f"{scratch}/source"
    for rows in _days(transactions_raw(spark, sf_dir))[:2]:
        source_frame(rows).write.mode("append").option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)
        ingest_new_files(spark, path, layout, RUN_DATE, f"{scratch}/checkpoint", 3)
    ingest_new_files(spark, path, layout, RUN_DATE, f"{scratch}/checkpoint", 3)
    return read_raw(spark, layout)


@query("curate_job_two_dates")
def curate_job_two_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curate a raw table of two dates, all at once; rows survive once per date."""
    layout = Layout(scratch_dir(spark))
    raw = two_dates(transactions_raw(spark, sf_dir))
    write_partitions(raw, layout.raw, ["processing_date"])
    run_curate(spark, layout)
    return read_curated(spark, layout).transform(epoch_seconds)


def _days(raw: DataFrame) -> list[DataFrame]:
    """Three days of one source: every third second each."""
    day = F.pmod(F.coalesce(F.unix_seconds(epoch_to_timestamp(lenient_long("timestamp"))), F.lit(0)), 3)
    return [raw.filter(day == k) for k in range(3)]


def _run_day(
    spark: SparkSession, scratch: str, name: str, rows: DataFrame, date: str, **options: bool
) -> Layout:
    path = f"{scratch}/source-{name}"
    write_csv_strings(source_frame(rows), path)
    return run_pipeline(spark, path, f"{scratch}/lake", date, **options)


@query("incremental_two_days")
def incremental_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report and both outputs after day 1, day 2 and day 1 again, with other rows."""
    scratch = scratch_dir(spark)
    one, two, _ = _days(transactions_raw(spark, sf_dir))
    _run_day(spark, scratch, "1", two.unionByName(one), RUN_DATE)
    _run_day(spark, scratch, "2", two, NEXT_DATE)
    layout = _run_day(spark, scratch, "3", one, RUN_DATE)
    raw = spark.read.json(layout.quality_report).select("raw.*", "curated.removed_records")
    names = raw.columns
    return (
        raw.select(F.explode(F.map_from_arrays(
            F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names])
        )).alias("key", "value"))
        .select(F.lit("report").alias("output"), "key", "value")
        .union(_outputs(spark, layout))
    )


@query("keyed_latest_sales")
def keyed_latest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest sale of each address after three days and a late correction of the second.

    The correction loses every other row, among them latest sales.
    """
    layout = Layout(scratch_dir(spark))
    days = _days(transactions_raw(spark, sf_dir))
    loads = [*zip(THREE_DATES, days, strict=True), (THREE_DATES[1], _corrected(days[1]))]
    for date, rows in loads:
        write_partitions(
            rows.withColumn("processing_date", F.lit(date)), layout.raw, ["processing_date"]
        )
        run_curate(spark, layout, [date])
        latest = update_latest_sales(spark, layout)
    return latest.drop("processing_date").transform(epoch_seconds)


def _corrected(rows: DataFrame) -> DataFrame:
    return rows.filter(
        F.coalesce(F.length("receiving_address") + F.length("amount"), F.lit(0)) % 2 == 0
    )


@query("sketched_ranges")
def sketched_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and risk quantiles of ranges of dates, from sketches that are kept by date.

    Day 2 is corrected after its sketch was stored. What the sketches only estimate is held
    against the curated rows: three percent of the addresses, two of the ranks.
    """
    layout = Layout(scratch_dir(spark))
    days = _days(transactions_raw(spark, sf_dir))
    loads = [*zip(THREE_DATES, days, strict=True), (THREE_DATES[1], _corrected(days[1]))]
    for date, rows in loads:
        write_partitions(
            rows.withColumn("processing_date", F.lit(date)), layout.raw, ["processing_date"]
        )
        run_curate(spark, layout, [date])
        update_sketches(spark, layout)
    ranges = [(a, b) for k, a in enumerate(THREE_DATES) for b in THREE_DATES[k:]]
    return reduce(DataFrame.union, [_range_of_dates(spark, layout, a, b) for a, b in ranges])


def _range_of_dates(spark: SparkSession, layout: Layout, first: str, last: str) -> DataFrame:
    told = sketched_range(spark, layout, first, last).first().asDict()
    rows = read_curated(spark, layout).filter(F.col("processing_date").between(first, last))
    address = F.when(valid_address("receiving_address"), F.col("receiving_address"))
    risk = F.col("risk_score")

    def rank_within(name: str, at: float) -> Column:
        """Are so many scores below the estimate, and so many not above it?"""
        below = F.count_if(risk < told[name]) / F.count(risk)
        upto = F.count_if(risk <= told[name]) / F.count(risk)
        return ((below <= at + 0.02) & (upto >= at - 0.02)).alias(f"{name}_within")

    apart = F.abs(F.lit(told["distinct_values"]) - F.count_distinct(address))
    return rows.agg(
        F.count_distinct(address).alias("addresses"),
        (apart <= 0.03 * F.count_distinct(address)).alias("addresses_within"),
        *[rank_within(name, at) for name, at in RISK_QUANTILES.items()],
    ).select(
        F.lit(first).alias("first_date"),
        F.lit(last).alias("last_date"),
        F.lit(told["n"]).cast("bigint").alias("curated_records"),
        F.lit(told["values"]).cast("bigint").alias("risk_scores"),
        "*",
    )


@query("empty_load")
def empty_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with a header and no rows, as the first load, on a filled day, on another."""
    scratch = scratch_dir(spark)
    rows = transactions_raw(spark, sf_dir)
    layout = _run_day(spark, scratch, "0", rows.limit(0), RUN_DATE)
    first = _sizes(spark, layout, "first")
    _run_day(spark, scratch, "1", rows, RUN_DATE)
    for name, date in (("2", RUN_DATE), ("3", NEXT_DATE)):
        _run_day(spark, scratch, name, rows.limit(0), date)
    return first.union(_sizes(spark, layout, "later"))


def _sizes(spark: SparkSession, layout: Layout, when: str) -> DataFrame:
    """Rows and columns of the layers, as they are now."""
    tables = {
        "raw": read_raw(spark, layout),
        "curated": read_curated(spark, layout),
        "avg_risk": read_table(spark, layout.avg_risk_score_by_region),
        "top3": read_table(spark, layout.top3_receiving_address),
    }
    sizes = [(when, name, df.count(), ",".join(df.columns)) for name, df in tables.items()]
    return spark.createDataFrame(sizes, "stage string, layer string, n bigint, columns string")


@query("narrow_load")
def narrow_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second day whose file lacks two columns: they are NULL in raw and curated."""
    scratch = scratch_dir(spark)
    rows = transactions_raw(spark, sf_dir)
    layout = _run_day(spark, scratch, "1", rows, RUN_DATE)
    path = f"{scratch}/narrow"
    write_csv_strings(source_frame(rows).drop("Sending Address", "Risk Score"), path)
    run_landing(spark, path, layout, NEXT_DATE)
    load_raw(spark, layout, NEXT_DATE)
    run_curate(spark, layout, [NEXT_DATE])
    return read_curated(spark, layout).transform(epoch_seconds)


@query("dq_missing_output")
def dq_missing_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a lake whose outputs were never written: told, not failed."""
    layout = Layout(scratch_dir(spark))
    write_partitions(transactions_raw(spark, sf_dir), layout.raw, ["processing_date"])
    run_curate(spark, layout)
    run_quality(spark, layout, RUN_DATE)
    report = spark.read.json(layout.quality_report)
    return report.select(
        F.col("landing.file_exists").alias("landing_file_exists"),
        F.col("raw.total_records").alias("total_records"),
        *flat_outputs("analytics."),
    )


@query("one_version_back")
def one_version_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, then only the sales, then a version that fails its check."""
    path = f"{scratch_dir(spark)}/table"
    raw = transactions_raw(spark, sf_dir)
    publish_table(raw, path)
    publish_table(raw.filter(F.col("transaction_type") == " sale "), path)
    with suppress(VersionError):
        publish_table(raw.limit(0), path, check=lambda written: not written.isEmpty())
    before = read_table(spark, path, back=1).withColumn("version", F.lit("before"))
    return read_table(spark, path).withColumn("version", F.lit("current")).union(before)


def _pipeline(spark: SparkSession, sf_dir: str) -> Layout:
    scratch = scratch_dir(spark)
    return run_pipeline(spark, source_csv(spark, sf_dir, scratch), scratch, RUN_DATE)


@query("dq_report")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report file of a whole run, one column per field."""
    layout = _pipeline(spark, sf_dir)
    report = spark.read.json(layout.quality_report)
    return report.select(
        "execution_date",
        F.col("landing.file_exists").alias("landing_file_exists"),
        F.replace("landing.file_path", F.lit(layout.base), F.lit("")).alias("landing_file_path"),
        "raw.*",
        F.col("curated.total_records").alias("curated_total_records"),
        F.col("curated.removed_records").alias("curated_removed_records"),
        *flat_outputs("analytics."),
    )


@query("pipeline_end_to_end")
def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both analytic tables and the row counts of the layers after a whole run."""
    return _outputs(spark, _pipeline(spark, sf_dir))


def _outputs(spark: SparkSession, layout: Layout) -> DataFrame:
    def rows(df: DataFrame, output: str, key: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(output).alias("output"), key.alias("key"), value.cast("double").alias("value")
        )

    avg = read_table(spark, layout.avg_risk_score_by_region)
    top3 = read_table(spark, layout.top3_receiving_address)
    n = F.count(F.lit(1))
    return (
        rows(avg, "avg_risk_score", F.col("location_region"), F.col("avg_risk_score"))
        .union(rows(top3, "latest_amount", F.col("receiving_address"), F.col("amount")))
        .union(
            rows(
                top3,
                "latest_time",
                F.col("receiving_address"),
                F.unix_seconds("timestamp"),
            )
        )
        .union(rows(read_raw(spark, layout).agg(n.alias("n")), "rows", F.lit("raw"), F.col("n")))
        .union(
            rows(
                read_curated(spark, layout).agg(n.alias("n")),
                "rows",
                F.lit("curated"),
                F.col("n"),
            )
        )
    )
