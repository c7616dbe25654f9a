"""Small files and directories, on whatever file system a path belongs to.

Only the driver uses these, for one-line files and listings of one directory.
"""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_filled(spark: SparkSession, path: str) -> bool:
    """True if the directory at ``path`` is there and not empty; asks for one entry."""
    files, target = _located(spark, path)
    return files.exists(target) and files.listStatusIterator(target).hasNext()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a directory, sorted; none if it is not there."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None if it is not there."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and move it over the old one in a single step.

    A reader sees the old or the new content, where the file system renames atomically.
    """
    files, target = _located(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(files.makeQualified(aside), files.makeQualified(target), how)
