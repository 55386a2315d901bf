"""The jobs from the command line, for ``spark-submit`` or ``python -m dayloom``.

    python -m dayloom run-daily --root /data/raw --facts w.observations --summary w.daily --date 2026-07-12
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from dayloom.operators import tables
from dayloom.operators.quality import DataQualityError, gate
from dayloom.plans import jobs
from dayloom.session import build_session
from dayloom.sources.landing import expire_landing
from dayloom.streaming.ingest import create_ingest_tables, ingest_available, ingest_into_tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dayloom", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, dated: bool = False) -> argparse.ArgumentParser:
        one = commands.add_parser(name, help=text)
        one.add_argument("--root", required=True, help="landing zone, holds load_date=YYYY-MM-DD folders")
        one.add_argument("--facts", required=True, help="fact table")
        one.add_argument("--summary", required=True, help="daily summary table")
        one.add_argument("--rejects", help="table for rejected lines")
        one.add_argument("--cluster-by", nargs="*", help="order facts by these columns inside each day")
        one.add_argument("--mode", choices=["quarantine", "strict"], default="quarantine")
        one.add_argument("--lineage", choices=["file", "pattern"], default="file")
        if dated:
            one.add_argument("--date", required=True, type=date.fromisoformat, help="run date")
        return one

    command("create-tables", "define the tables")
    command("load", "parse one date's folder and append its records", dated=True)
    daily = command("run-daily", "load one date, refresh its summary, gate on its rows", dated=True)
    daily.add_argument("--least-rows", type=int, default=4)
    daily.add_argument("--gate-at", choices=["before_summary", "after_summary"], default="after_summary")
    build = command("build-all", "append new days, test, rebuild the summary, reconcile")
    build.add_argument("--full-refresh", action="store_true")
    build.add_argument("--only-new-days", action="store_true")
    build.add_argument("--start", type=date.fromisoformat, help="leave older landing folders unread")
    build.add_argument("--end", type=date.fromisoformat, help="leave later landing folders unread")
    refresh = command("refresh-summary", "recompute the summary of the days the facts have")
    refresh.add_argument("--round-digits", type=int)
    command("report", "print the data-quality report; fails when a check does")
    ingest = command("ingest", "process the files landed since the last call, each exactly once")
    ingest.add_argument("--target", help="folder of the ingested rows; without it they go to the tables, by day and batch")
    ingest.add_argument("--checkpoint", required=True, help="folder that remembers the files taken")
    expire = command("expire", "drop landed folders and fact partitions older than some days", dated=True)
    expire.add_argument("--days", type=int, default=7)
    return top


def run(given: argparse.Namespace) -> None:
    spark = build_session()
    lake = jobs.Lake(
        given.root, given.facts, given.summary, given.rejects, mode=given.mode, lineage=given.lineage,
        cluster_by=None if given.cluster_by is None else tuple(given.cluster_by))
    if given.command == "create-tables":
        jobs.create_tables(spark, lake)
    elif given.command == "load":
        jobs.load_run_date(spark, lake, given.date)
    elif given.command == "run-daily":
        jobs.run_daily(spark, lake, given.date, least_rows=given.least_rows, gate_at=given.gate_at)
    elif given.command == "build-all":
        landed, rows = jobs.build_all(
            spark, lake, given.full_refresh, start=given.start, end=given.end, only_new_days=given.only_new_days)
        print(f"appended {landed.appended_rows} rows, skipped {landed.skipped_rows}; {len(rows)} checks passed")
    elif given.command == "refresh-summary":
        jobs.refresh_summary(spark, lake, given.round_digits)
    elif given.command == "report":
        checked = jobs.quality_report(spark, lake)
        for row in gate(checked):
            print(f"{row.status} {row.check_name} {row.violations}")
    elif given.command == "ingest":
        if given.target:
            ingest_available(spark, lake.root, given.target, given.checkpoint, lake.feed, mode=lake.mode)
        else:
            if not lake.rejects:
                raise SystemExit("--rejects names the table of the rejected lines")
            if not spark.catalog.tableExists(lake.facts):
                create_ingest_tables(spark, lake.facts, lake.rejects, lake.feed)
            ingest_into_tables(spark, lake.root, lake.facts, lake.rejects, given.checkpoint, lake.feed, mode=lake.mode)
    elif given.command == "expire":
        folders = expire_landing(spark, lake.root, given.date, given.days)
        parts = tables.expire(spark, lake.facts, lake.feed.day, given.date, given.days)
        print(f"removed {len(folders)} folders and {len(parts)} partitions")


def main(arguments: list[str] | None = None) -> int:
    try:
        run(parser().parse_args(arguments))
    except DataQualityError as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
