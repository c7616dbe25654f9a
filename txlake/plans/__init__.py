"""Jobs that read and write the layers, and the flow that runs them all."""

from txlake.plans.jobs import (
    curate_new,
    load_raw,
    run_avg_risk,
    run_curate,
    run_landing,
    run_quality,
    run_top3,
)
from txlake.plans.pipeline import run_pipeline
from txlake.plans.session import get_spark

__all__ = [
    "curate_new",
    "get_spark",
    "load_raw",
    "run_avg_risk",
    "run_curate",
    "run_landing",
    "run_pipeline",
    "run_quality",
    "run_top3",
]
