"""Run one stage or the whole flow: ``python -m txlake <stage> --base <uri> ...``."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from txlake.plans import (
    curate_new,
    get_spark,
    load_raw,
    run_avg_risk,
    run_curate,
    run_landing,
    run_pipeline,
    run_quality,
    run_top3,
)
from txlake.sources import Layout

STAGES = ("landing", "raw", "curated", "avg-risk", "top3", "quality", "pipeline")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="txlake", description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--base", required=True, help="URI under which all layers are kept")
    parser.add_argument("--source", help="source CSV; for landing and pipeline")
    parser.add_argument(
        "--run-date",
        default=datetime.now(UTC).date().isoformat(),
        help="yyyy-MM-dd, the UTC date of today by default",
    )
    parser.add_argument("--dates", nargs="+", help="curate only these dates")
    parser.add_argument("--rebuild", action="store_true", help="curate all dates again")
    parser.add_argument("--format", default="parquet", help="table format, e.g. delta")
    args = parser.parse_args(argv)
    if args.stage in ("landing", "pipeline") and not args.source:
        parser.error(f"{args.stage} needs --source")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = get_spark(f"txlake-{args.stage}", args.format)
    layout = Layout(args.base)
    try:
        match args.stage:
            case "landing":
                run_landing(spark, args.source, layout, args.run_date)
            case "raw":
                load_raw(spark, layout, args.run_date, args.format)
            case "curated":
                if args.dates or args.rebuild:
                    run_curate(spark, layout, None if args.rebuild else args.dates, args.format)
                else:
                    curate_new(spark, layout, args.run_date, args.format)
            case "avg-risk":
                run_avg_risk(spark, layout, args.format, preview=True)
            case "top3":
                run_top3(spark, layout, args.format, preview=True)
            case "quality":
                run_quality(spark, layout, args.run_date, args.format, preview=True)
            case "pipeline":
                run_pipeline(
                    spark,
                    args.source,
                    args.base,
                    args.run_date,
                    args.format,
                    args.dates,
                    preview=True,
                    rebuild=args.rebuild,
                )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
