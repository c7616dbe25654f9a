"""Whole tables by version: write aside, check, then switch a one-line pointer.

A table is a directory of version directories and a file with one line, which names the
current one and those before it that are kept.
Readers follow the pointer, so they see all of a version or none of it, and a write that
fails, or whose check fails, changes nothing. Some earlier versions are kept: readers that
began before a switch can finish, and ``read_table(..., back=1)`` reads the one before.
There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txlake.sources.files import names_in, read_text, remove, replace_text

CURRENT = "_current"
KEPT = 3


class VersionError(ValueError):
    """There is no such version, or a new one does not pass its check."""


def versions(spark: SparkSession, path: str) -> list[str]:
    """The published versions that are kept, oldest first; none for a plain table."""
    return (read_text(spark, f"{path}/{CURRENT}") or "").split()[::-1]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the current version, or None for a table that has no versions."""
    held = versions(spark, path)
    return held[-1] if held else None


def version_path(spark: SparkSession, path: str, back: int = 0) -> str:
    """Where the current version is, or the one ``back`` versions before it."""
    held = versions(spark, path)
    if not held and not back:
        return path
    if back >= len(held):
        raise VersionError(f"the table at {path} has {len(held)} versions")
    return f"{path}/{held[-1 - back]}"


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    check: Callable[[str], None] | None = None,
    kept: int = KEPT,
) -> str:
    """``write`` a new version to the path it is given, ``check`` it there, then switch.

    Both raise to leave the table as it is. Returns the path of the new version; the last
    ``kept`` versions stay, and what older or failed writes left is removed.
    """
    # Names that sort as they were made; those of failed writes are not used again.
    used = [n for n in names_in(spark, path) if n.startswith("v")]
    name = f"v{int(used[-1][1:]) + 1 if used else 1:09d}"
    target = f"{path}/{name}"
    write(target)
    if check is not None:
        check(target)
    listed = [name, *versions(spark, path)[::-1]][:kept]
    replace_text(spark, f"{path}/{CURRENT}", " ".join(listed) + "\n")
    for old in used:
        if old not in listed:
            remove(spark, f"{path}/{old}")
    return target


def publish_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    check: Callable[[DataFrame], bool] | None = None,
    kept: int = KEPT,
) -> None:
    """Replace a whole table by a new version; ``check`` sees it as it was written."""
    spark = df.sparkSession

    def write(target: str) -> None:
        df.write.format(fmt).mode("overwrite").save(target)

    def checked(target: str) -> None:
        if check is not None and not check(spark.read.format(fmt).load(target)):
            raise VersionError(f"the new version of {path} does not pass its check")

    publish(spark, path, write, checked, kept)
