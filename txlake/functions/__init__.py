"""Column-level building blocks: casts, row predicates and column names."""

from txlake.functions.casts import epoch_to_timestamp, lenient_date, lenient_double, lenient_long
from txlake.functions.predicates import (
    invalid_address,
    invalid_double,
    invalid_long,
    invalid_region,
    is_category,
    valid_address,
    valid_region,
)

__all__ = [
    "epoch_to_timestamp",
    "invalid_address",
    "invalid_double",
    "invalid_long",
    "invalid_region",
    "is_category",
    "lenient_date",
    "lenient_double",
    "lenient_long",
    "valid_address",
    "valid_region",
]
