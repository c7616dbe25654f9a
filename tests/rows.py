"""Small hand-made transaction tables."""

from __future__ import annotations

RAW_COLUMNS = (
    "timestamp",
    "sending_address",
    "receiving_address",
    "amount",
    "risk_score",
    "transaction_type",
    "location_region",
    "processing_date",
)

_DEFAULTS = {
    "timestamp": "1649000000",
    "sending_address": "s",
    "receiving_address": "r",
    "amount": "10.5",
    "risk_score": "50",
    "transaction_type": "sale",
    "location_region": "ASIA",
    "processing_date": "2024-02-01",
}


def raw(spark, *changes: dict, extra: tuple[str, ...] = ()):
    """All-string raw rows: defaults with the given changes, one row per dictionary."""
    columns = RAW_COLUMNS + extra
    rows = [tuple((_DEFAULTS | change).get(c) for c in columns) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
