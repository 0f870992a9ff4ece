"""Command line: one ingestion run, or a refresh of landed deliveries.

    python -m tidemark ingest --org-reports ... --user-reports ... --root ...
    python -m tidemark refresh --landing ... --out ... --checkpoint ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .fields import RAW_TABLES
from .plans.ingest import ingest, ingest_landed
from .streaming.refresh import refresh


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("ingest", help="build and publish the views from NDJSON reports")
    run.add_argument("--org-reports", nargs="+")
    run.add_argument("--user-reports", nargs="+")
    run.add_argument("--landing", help="a landing area, instead of single report files")
    run.add_argument("--root", required=True)
    run.add_argument("--org")
    run.add_argument("--source", default="reports")
    run.add_argument("--trigger", default="manual")
    run.add_argument("--report-window-days", type=int, default=100)
    run.add_argument("--format", choices=["parquet", "json"], default="parquet")
    inc = commands.add_parser("refresh", help="process the deliveries that landed since last time")
    inc.add_argument("--landing", required=True)
    inc.add_argument("--out", required=True)
    inc.add_argument("--checkpoint", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    parser = arguments()
    args = parser.parse_args(argv)
    if args.command == "ingest" and not args.landing and not (
            args.org_reports and args.user_reports):
        parser.error("ingest needs --landing, or --org-reports and --user-reports")
    spark = (
        SparkSession.builder.appName("tidemark")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if args.command == "ingest":
        options = dict(
            org=args.org, source=args.source, trigger=args.trigger, fmt=args.format,
            report_window_days=args.report_window_days,
        )
        if args.landing:
            run = ingest_landed(spark, args.landing, args.root, **options)
        else:
            run = ingest(spark, args.org_reports, args.user_reports, args.root, **options)
        print(run["id"], run["status"], run["snapshot_records"])
    else:
        for table in RAW_TABLES:
            refresh(spark, args.landing, args.out, table, f"{args.checkpoint}/{table}")


if __name__ == "__main__":
    main()
