"""Jobs for spark-submit: load, stream and refresh."""

from __future__ import annotations

import argparse

from panelmill.functions import parse_names
from panelmill.plans.load import load_batch
from panelmill.plans.refresh import refresh_all
from panelmill.plans.registry import CURATED, DEFAULT_VIEWS
from panelmill.session import session
from panelmill.sources import JdbcMaster, SeedMaster, SnapshotMaster
from panelmill.streaming import run_stream


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="panelmill", description=__doc__)
    parser.add_argument("--shuffled-bytes", type=int, help="expected shuffle size, sets partitions")
    jobs = parser.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="store all raw files, or one, as processed bars")
    stream = jobs.add_parser("stream", help="store the files that are new, then refresh")
    refresh = jobs.add_parser("refresh", help="rebuild the curated tables")
    for job in (load, stream):
        job.add_argument("--raw", required=True)
        job.add_argument("--layout", choices=["full", "compact"], default="compact")
        kind = job.add_mutually_exclusive_group()
        kind.add_argument("--master-seed")
        kind.add_argument("--master-snapshot")
        kind.add_argument("--master-jdbc")
    for job in (load, stream, refresh):
        job.add_argument("--processed", required=True)
    load.add_argument("--mode", choices=["append", "replace"], default="append")
    load.add_argument("--day", help="take the bars of this date only; yesterday for the day before today")
    load.add_argument("--require-master", action="store_true", help="fail without a master")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--curated")
    stream.add_argument("--max-files", type=int)
    refresh.add_argument("--curated", required=True)
    refresh.add_argument("--incremental", action="store_true",
                         help="build only the months that loads since the last refresh reach")
    for job in (stream, refresh):
        job.add_argument("--views", type=parse_names, default=list(DEFAULT_VIEWS),
                         help=f"comma-separated, of: {', '.join(CURATED)}")
    return parser.parse_args(argv)


def _master(args: argparse.Namespace):
    if args.master_seed:
        return SeedMaster(args.master_seed)
    if args.master_snapshot:
        return SnapshotMaster(args.master_snapshot)
    return JdbcMaster(args.master_jdbc) if args.master_jdbc else None


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = session(f"panelmill-{args.job}", args.shuffled_bytes)
    reports = []
    if args.job == "load":
        print(load_batch(spark, args.raw, args.processed, _master(args), args.layout, args.mode,
                         args.require_master, args.day))
    elif args.job == "stream":
        reports = run_stream(
            spark, args.raw, args.processed, args.checkpoint, _master(args), args.curated,
            args.layout, args.views, args.max_files)
    else:
        reports = [refresh_all(spark, args.processed, args.curated, args.views, incremental=args.incremental)]
    # One row per view, so the reports are a handful of rows.
    outcomes = [row for report in reports for row in report.collect()]
    for row in outcomes:
        print(row["view_name"], row["status"], row["location"] or row["error"])
    return 1 if any(row["status"] == "FAILED" for row in outcomes) else 0


if __name__ == "__main__":
    raise SystemExit(main())
