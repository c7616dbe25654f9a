"""From raw text rows to typed, trimmed, exactly deduplicated rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions.casts import epoch_to_timestamp, lenient_date, lenient_double, lenient_long
from txlake.functions.names import (
    AMOUNT,
    LOCATION_REGION,
    PROCESSING_DATE,
    RECEIVING_ADDRESS,
    RISK_SCORE,
    SENDING_ADDRESS,
    TIMESTAMP,
    TRANSACTION_TYPE,
    column,
)

TRIMMED = (TRANSACTION_TYPE, LOCATION_REGION, SENDING_ADDRESS, RECEIVING_ADDRESS)
DOUBLES = (AMOUNT, RISK_SCORE)


def exact_dedup(df: DataFrame) -> DataFrame:
    """One of each set of rows that are equal in every column (NULLs are equal).

    Copies are merged on the map side first, so a much-repeated row is not a hot key.
    """
    return df.dropDuplicates()


def trim_columns(df: DataFrame, names: Iterable[str] = TRIMMED) -> DataFrame:
    """Strip leading and trailing spaces (not tabs) of the named columns."""
    return df.withColumns({name: F.trim(column(name)) for name in names})


def type_columns(
    df: DataFrame,
    timestamp: str = TIMESTAMP,
    doubles: Iterable[str] = DOUBLES,
    processing_date: str = PROCESSING_DATE,
) -> DataFrame:
    """Epoch text to timestamp, numbers to double, run date to date; bad text to NULL."""
    return df.withColumns(
        {
            timestamp: epoch_to_timestamp(lenient_long(timestamp)),
            **{name: lenient_double(name) for name in doubles},
            processing_date: lenient_date(processing_date),
        }
    )


def curate(df: DataFrame) -> DataFrame:
    """Deduplicate the raw text first, then type and trim. No row is filtered out."""
    return df.transform(exact_dedup).transform(type_columns).transform(trim_columns)
