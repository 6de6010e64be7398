"""Run the chain: python -m tillhouse --source /data/till --root /data/lake --date 2026-05-01"""

from __future__ import annotations

import argparse
import logging
import os
from datetime import datetime, timezone

from tillhouse.functions.fixed_values import CALENDAR_END
from tillhouse.layout import Layout, lookback_days, parse_day, resolve_days, storage_section
from tillhouse.plans.runs import run_days
from tillhouse.session import get_spark
from tillhouse.sources.source import JdbcSource, ParquetSource


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillhouse")
    parser.add_argument("--date", default="", help="one day, YYYY-MM-DD; wins over a range")
    parser.add_argument("--start-date", default="", help="first day; alone it is the only day")
    parser.add_argument("--end-date", default="", help="last day")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--source", help="folder with one Parquet table per source table")
    source.add_argument("--jdbc-url", help="till database; user and password come from TILL_DB_USER and TILL_DB_PASSWORD")
    parser.add_argument("--readers", type=int, default=8, help="parallel database readers")
    parser.add_argument("--lookback", type=int, default=0, help="days before each day that its late rows may belong to")
    parser.add_argument("--catch-up", action="store_true", help="also run earlier days whose source rows have changed")
    parser.add_argument("--database", help="catalog database whose tables follow the run")
    parser.add_argument("--check-freshness", action="store_true", help="test the age of the newest order, too")
    parser.add_argument("--test-everything", action="store_true", help="test all days, not those of the run")
    parser.add_argument("--calendar-end", default=CALENDAR_END, help="last day of dim_date")
    parser.add_argument("--normalize-tier", action="store_true", help="read 'Tier 1' as 1")
    parser.add_argument("--root", help="one folder for all layers")
    parser.add_argument("--config", help="YAML or JSON file with a storage section")
    for layer in ("bronze", "silver", "quarantine", "gold"):
        parser.add_argument(f"--{layer}", help=f"bucket or folder of the {layer} layer")
    return parser


def layout_of(options: argparse.Namespace) -> Layout:
    given = {layer: getattr(options, layer) for layer in ("bronze", "silver", "quarantine", "gold")}
    if options.root:
        below = Layout.under(options.root)
        given = {layer: value or getattr(below, layer) for layer, value in given.items()}
    return Layout.from_settings(given, os.environ, storage_section(options.config) if options.config else None)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    options = arguments().parse_args(argv)
    layout = layout_of(options)
    days = resolve_days(options.date, options.start_date, options.end_date)
    if not days:
        raise SystemExit("the end date lies before the start date")
    spark = get_spark(paths=(layout.bronze, layout.silver, layout.quarantine, layout.gold))
    if options.jdbc_url:
        login = {"user": os.environ.get("TILL_DB_USER", ""), "password": os.environ.get("TILL_DB_PASSWORD", "")}
        source = JdbcSource(spark, options.jdbc_url, login, options.readers)
    else:
        source = ParquetSource(spark, options.source)
    days = sorted({late for day in days for late in lookback_days(day, options.lookback)})
    calendar_end = parse_day(options.calendar_end).isoformat()
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S") if options.check_freshness else None
    results = run_days(
        spark,
        source,
        layout,
        days,
        calendar_end=calendar_end,
        normalize_tier=options.normalize_tier,
        catch_up=options.catch_up,
        database=options.database,
        now=now,
        test_everything=options.test_everything,
    ).collect()
    for row in results:
        print(f"{row.status:5} {row.violations:>8} {row.test_name}")
    if any(row.status == "fail" for row in results):
        raise SystemExit("data tests failed")


if __name__ == "__main__":
    main()
