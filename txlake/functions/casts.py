"""Casts that turn bad text into NULL, whatever the session's ANSI mode or time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.functions.names import ColumnOrName, column

# timestamp_seconds works in microseconds, so seconds beyond this overflow a long.
_MAX_EPOCH_SECONDS = (2**63 - 1) // 1_000_000

_FRACTION = r"^(\s*[+-]?)([0-9]*)[.][0-9]*(\s*)$"


def lenient_double(c: ColumnOrName) -> Column:
    return column(c).try_cast("double")


def lenient_long(c: ColumnOrName) -> Column:
    """String to bigint, dropping a decimal fraction (``'12.7'`` -> 12, ``'.5'`` -> 0).

    The regular expression runs only for text that is not already a plain integer.
    """
    text = column(c)
    return F.coalesce(
        text.try_cast("bigint"),
        F.regexp_replace(text, _FRACTION, "$10$2$3").try_cast("bigint"),
    )


def lenient_date(c: ColumnOrName) -> Column:
    return column(c).try_cast("date")


def epoch_to_timestamp(seconds: ColumnOrName) -> Column:
    """Epoch seconds (bigint) to timestamp; values no timestamp can hold become NULL."""
    s = column(seconds)
    return F.when(s.between(-_MAX_EPOCH_SECONDS, _MAX_EPOCH_SECONDS), F.timestamp_seconds(s))
