"""Row predicates: which values the analytics keep, and which the quality report counts.

``valid_*`` look at curated (trimmed) values, ``invalid_*`` at raw text. The two are not
exact opposites: a raw region ``' 0 '`` is not counted as invalid, but is ``'0'`` once
trimmed and is then left out of the analytics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.functions.casts import lenient_double, lenient_long
from txlake.functions.names import ColumnOrName, column

# Fixed value: the region code that stands for "unknown".
UNKNOWN_REGION = "0"


def valid_region(c: ColumnOrName) -> Column:
    region = column(c)
    return region.isNotNull() & (F.trim(region) != "") & (region != UNKNOWN_REGION)


def is_category(c: ColumnOrName, category: str) -> Column:
    return column(c) == category


def valid_address(c: ColumnOrName) -> Column:
    address = column(c)
    return address.isNotNull() & (address != "")


def invalid_double(c: ColumnOrName) -> Column:
    return lenient_double(c).isNull()


def invalid_long(c: ColumnOrName) -> Column:
    return lenient_long(c).isNull()


def invalid_region(c: ColumnOrName) -> Column:
    region = column(c)
    return region.isNull() | (F.trim(region) == "") | (region == UNKNOWN_REGION)


def invalid_address(c: ColumnOrName) -> Column:
    address = column(c)
    return address.isNull() | (F.trim(address) == "")
