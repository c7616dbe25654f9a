"""Column names of the transaction tables, and helpers to refer to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns the pipeline names. Any other column passes through.
TIMESTAMP = "timestamp"
AMOUNT = "amount"
RISK_SCORE = "risk_score"
TRANSACTION_TYPE = "transaction_type"
LOCATION_REGION = "location_region"
SENDING_ADDRESS = "sending_address"
RECEIVING_ADDRESS = "receiving_address"
PROCESSING_DATE = "processing_date"

ColumnOrName = Column | str


def quoted(name: str) -> str:
    """Backtick-quote a column name, so that dots and spaces in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def column(c: ColumnOrName) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c
