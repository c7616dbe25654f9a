"""DataFrame to DataFrame operators, lazy and usable with ``DataFrame.transform``."""

from txlake.operators.analytics import (
    SALE,
    avg_by_group,
    avg_risk_from_sums,
    avg_risk_score_by_region,
    daily_latest_sales,
    latest_per_key,
    latest_sales,
    merge_latest_sales,
    region_sums,
    top3_by_latest_sale_amount,
    top_sales,
    top_k,
    valid_sales,
)
from txlake.operators.curate import curate, exact_dedup, trim_columns, type_columns
from txlake.operators.cubes import cube_sums, merge_cubes
from txlake.operators.ingest import ColumnCollisionError, normalize_columns, stamp_run_date
from txlake.operators.joins import asof_join, within_join
from txlake.operators.quality import (
    build_report,
    count_copies,
    invalid_counts,
    distinct_totals,
    layer_totals,
    output_checks,
    profile_raw,
    with_conformity,
)
from txlake.operators.sketches import estimates, merge_sketches, sketch

__all__ = [
    "SALE",
    "ColumnCollisionError",
    "asof_join",
    "avg_by_group",
    "cube_sums",
    "estimates",
    "merge_cubes",
    "merge_sketches",
    "sketch",
    "within_join",
    "avg_risk_from_sums",
    "avg_risk_score_by_region",
    "daily_latest_sales",
    "merge_latest_sales",
    "region_sums",
    "top_sales",
    "build_report",
    "count_copies",
    "curate",
    "exact_dedup",
    "invalid_counts",
    "latest_per_key",
    "latest_sales",
    "distinct_totals",
    "layer_totals",
    "normalize_columns",
    "output_checks",
    "profile_raw",
    "stamp_run_date",
    "top3_by_latest_sale_amount",
    "top_k",
    "trim_columns",
    "type_columns",
    "valid_sales",
    "with_conformity",
]
