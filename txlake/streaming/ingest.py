"""New source files into a day's raw partition, each file once.

A stream over the source directory knows, by its checkpoint, which files it has seen. Every
micro-batch is landed in a directory of its own, named after the batch: a batch that is
replayed after a failure replaces what its first attempt left. The day's raw partition is
then loaded from all landed batches, as a whole, so it is the same however often it is run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from txlake.functions.names import PROCESSING_DATE
from txlake.operators.ingest import checked_date, normalize_columns, stamp_run_date
from txlake.plans.state import forget_raw
from txlake.sources.csv_files import read_csv_strings, write_csv_strings
from txlake.sources.files import names_in
from txlake.sources.layout import Layout
from txlake.sources.tables import write_partitions

#: One directory for each micro-batch, below the landing directory of the run date.
_BATCH = "batch-{:09d}"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    layout: Layout,
    run_date: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    fmt: str = "parquet",
) -> int:
    """Land the files of ``source`` that no earlier run landed, and load the day's raw rows.

    Runs until all files that are there have been seen, then stops. ``checkpoint`` belongs
    to ``source``. All files must have the header of those that are there at the start;
    reading fails where one differs. Returns the number of batches landed for the date.
    """
    run_date = checked_date(run_date)
    landing = f"{layout.landing(run_date)}_stream"
    names = read_csv_strings(spark, source).columns
    schema = StructType([StructField(n, StringType()) for n in names])

    def land(batch: DataFrame, number: int) -> None:
        write_csv_strings(batch, f"{landing}/{_BATCH.format(number)}")

    (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    landed = [f"{landing}/{n}" for n in names_in(spark, landing) if n.startswith("batch-")]
    if landed:
        rows = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .csv(landed)
            .transform(normalize_columns)
            .transform(stamp_run_date, run_date)
        )
        forget_raw(spark, layout, [run_date])
        write_partitions(rows, layout.raw, [PROCESSING_DATE], fmt)
    return len(landed)


def without_repeats(stream: DataFrame, keys: list[str], time: str, within: str) -> DataFrame:
    """Rows of a stream without those that repeat ``keys`` less than ``within`` later.

    State is kept for ``within`` of event time and no longer: the watermark drops keys, so
    its size follows the rate of the stream, not its age. Rows that are later than that
    behind the newest are dropped, too.
    """
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)
