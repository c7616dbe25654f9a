"""All-string CSV: the source format and the landing layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Read CSV with a header line, every column as a string.

    All files must have the same header: reading fails where one differs, rather than
    putting values under another file's names.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def write_csv_strings(df: DataFrame, path: str) -> None:
    """Write CSV that ``read_csv_strings`` reads back to the same values.

    Every part file has its own header, and whitespace, which the writer would trim by
    default, is kept. Only the empty string is not: CSV reads it back as NULL.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land_snapshot(spark: SparkSession, source: str, target: str) -> None:
    """Copy the source CSV (a file, a directory or a glob) into one landing directory.

    A repeated run replaces the directory. The copy has the same values, not the same
    bytes, and is made by all executors at once, without a shuffle.
    """
    write_csv_strings(read_csv_strings(spark, source), target)
