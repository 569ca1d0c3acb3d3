"""Runs the whole chain over a folder of feeds: ``python -m tallyloom FEEDS --out TABLE``.

A feed is a file or folder named after it, such as ``aws_cur.csv`` or ``anthropic_usage.json``; a generic
feed may have a Parquet side, such as ``billing_period.parquet``. The exit code is 1 when a check of
severity ``error`` fails, or a feed has an unexpected column or JSON key.
"""

from __future__ import annotations

import argparse
import sys

from tallyloom.plans.build import GENERIC_FEEDS, PROVIDER_FEEDS, Paths, build
from tallyloom.session import build_session


def _paths(folder: str) -> Paths:
    base = folder.rstrip("/")
    feeds = {
        feed: f"{base}/{feed}.{'json' if name == 'anthropic' else 'csv'}"
        for name, needed in PROVIDER_FEEDS.items()
        for feed in needed
    }
    return Paths(feeds)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tallyloom", description=__doc__)
    parser.add_argument("feeds", help="folder with the feeds")
    parser.add_argument("--provider", choices=list(PROVIDER_FEEDS), help="only this provider")
    parser.add_argument("--enabled", nargs="+", default=list(PROVIDER_FEEDS), help="providers to unite")
    parser.add_argument("--generic", nargs="*", default=[], choices=list(GENERIC_FEEDS))
    parser.add_argument(
        "--generic-parquet", nargs="*", default=[], choices=list(GENERIC_FEEDS),
        help="generic feeds that have a Parquet side",
    )
    parser.add_argument("--out", help="where to write cost and usage; checks then run on that table")
    parser.add_argument("--severity", choices=["error", "warn"], help="only checks of this severity")
    parser.add_argument("--freshness", type=float, metavar="HOURS", help="report feeds older than this")
    parser.add_argument("--tags", nargs="*", default=[], help="only checks with all these tags")
    parser.add_argument(
        "--parity", action="store_true",
        help="two cost types of a meter give two rows, of which the newest-row selection keeps one",
    )
    parser.add_argument(
        "--reconciled", action="store_true", help="a cost that meets no meter is billed in a row of its own"
    )
    args = parser.parse_args(argv)
    if args.parity and args.reconciled:
        parser.error("--parity and --reconciled exclude each other")

    spark = build_session()
    paths = _paths(args.feeds)
    base = args.feeds.rstrip("/")
    for name in {*args.generic, *args.generic_parquet}:
        paths.generic_csv[name] = f"{base}/{name}.csv"
    for name in args.generic_parquet:
        paths.generic_parquet[name] = f"{base}/{name}.parquet"
    run = build(spark, paths, args.provider, args.enabled, "reconciled" if args.reconciled else not args.parity)
    if args.out:
        run = run.write(args.out)
    drift: list[tuple[str, str]] = []
    if run.asserts_chosen(args.tags, args.severity):
        drift = run.schema_failures()
        # one row per unknown key
        drift += [
            (row["feed"], f"{row['level']} has unknown key {row['key']} in {row['objects']} objects")
            for row in run.key_drift().collect()
        ]
        for feed, column in run.missing_columns():
            print(f"note   {feed}: no column {column}")
    # the report has one row per configured check
    broken = [
        row for row in run.check(args.tags, args.severity).collect() if row["status"] != "pass"
    ]
    for feed, reason in drift:
        print(f"error  {feed}: {reason}")
    if args.freshness is not None:
        for row in run.freshness(warn_after_hours=args.freshness).collect():
            print(f"{row['status']:5}  {row['feed']}: newest row is {row['age_hours']} hours old")
    for row in broken:
        print(
            f"{row['status']:5}  {row['dataset']}.{row['column_name']}"
            f" {row['check_name']}: {row['violations']} rows"
        )
    failed = bool(drift) or any(row["status"] == "error" for row in broken)
    print("failed" if failed else "passed")
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
