"""Whole runs: extract, silver, history, gold, tests, for any number of days at once."""

from __future__ import annotations

from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.dates import recent
from tillhouse.functions.fixed_values import CALENDAR_END, RECENT_DAYS
from tillhouse.layout import Layout, lookback_days, stretches
from tillhouse.operators import checks, history, keysets
from tillhouse.plans import changes, gold, silver
from tillhouse.schemas import FACT, MASTERS, ORDER_ITEMS, PRIMARY_KEYS, SILVER_ORDERS, TRANSACTIONS
from tillhouse.session import (
    configure,
    discard,
    file_system,
    fresh_dir,
    run_together,
    size_shuffles,
    stored_bytes,
)
from tillhouse.sources import bronze, catalog, commits, tables


# The fact's key, and the table of its filters.
FACT_KEY, FACT_KEYS = "item_id", "fact_order_items_keys"


def extract(spark: SparkSession, source, layout: Layout, days: list[date]) -> None:
    """Masters in full, transactions of the given days, all as raw files."""

    def master(name: str) -> None:
        bronze.write_master(source.table(name), f"{layout.bronze}/{name}")

    def transactions(name: str) -> None:
        scan = source.orders if name == "orders" else source.items
        columns = TRANSACTIONS[name].fieldNames()
        # one range per stretch of days: what lies in a gap between them is not read
        rows = reduce(DataFrame.unionByName, [scan(first, last) for first, last in stretches(days)])
        bronze.write_transactions(rows, columns, f"{layout.bronze}/{name}", days)

    jobs = [*(partial(master, name) for name in MASTERS), *(partial(transactions, name) for name in TRANSACTIONS)]
    run_together(spark, jobs)


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the complete folders name=<number> of a history, oldest first."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for entry in fs.listStatus(root):
        folder = entry.getPath().getName()
        _, marker = file_system(spark, f"{path}/{folder}/_SUCCESS")
        if folder.startswith(f"{name}=") and fs.exists(marker):
            found.append(int(folder.removeprefix(f"{name}=")))
    return sorted(found)


def read_open(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """The open versions of a history, one row per key."""
    path = f"{layout.gold}/snp_{table}"
    found = _numbers(spark, path, "version")
    return spark.read.parquet(f"{path}/version={found[-1]:06d}") if found else None


def read_history(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """All versions: the open ones, and what every load up to theirs has closed."""
    path = f"{layout.gold}/snp_{table}"
    found = _numbers(spark, path, "version")
    if not found:
        return None
    open_rows = spark.read.parquet(f"{path}/version={found[-1]:06d}")
    closed = [f"{path}/closed={n:06d}" for n in _numbers(spark, path, "closed") if n <= found[-1]]
    return open_rows.unionByName(spark.read.schema(open_rows.schema).parquet(*closed)) if closed else open_rows


def refresh_history(spark: SparkSession, layout: Layout, table: str, master: DataFrame) -> DataFrame:
    """Merge a master into its history.

    Closed versions never change again: a load writes those it closes to a folder of its own and rewrites the open ones only,
    so its cost goes by the master's size and not by the history's. The open ones go to a new folder beside the one being
    read, and with its success marker the load counts. One that dies half-way leaves folders that no reader picks up and
    the next load writes anew; the open versions before those that were read are removed.
    """
    path = f"{layout.gold}/snp_{table}"
    key = PRIMARY_KEYS[table]
    found = _numbers(spark, path, "version")
    stored = read_open(spark, layout, table)
    load = found[-1] + 1 if found else 1
    if stored is None:
        merged = history.first_load(master, key)
    else:
        merged = history.merge(stored, master, key)
        tables.write_table(merged.filter("valid_to IS NOT NULL"), f"{path}/closed={load:06d}")
    tables.write_table(history.current_rows(merged), f"{path}/version={load:06d}")
    for old in found[:-1]:
        fs, folder = file_system(spark, f"{path}/version={old:06d}")
        fs.delete(folder, True)
    return read_history(spark, layout, table)


def build_gold(
    spark: SparkSession,
    layout: Layout,
    days: list[date],
    masters: dict[str, DataFrame],
    calendar_end: str = CALENDAR_END,
    normalize_tier: bool = False,
) -> None:
    def menu() -> None:
        stored = refresh_history(spark, layout, "menu_master", masters["menu_master"])
        tables.write_table(gold.dim_menu(stored), f"{layout.gold}/dim_menu")

    def outlet() -> None:
        stored = refresh_history(spark, layout, "outlet_master", masters["outlet_master"])
        tables.write_table(gold.dim_outlet(stored, normalize_tier), f"{layout.gold}/dim_outlet")

    def dates() -> None:
        tables.write_table(gold.calendar(spark, end=calendar_end), f"{layout.gold}/dim_date")

    def fact() -> None:
        orders = tables.read_day_files(spark, f"{layout.silver}/orders", SILVER_ORDERS, days)
        items = tables.read_day_files(spark, f"{layout.silver}/order_items", ORDER_ITEMS, days)
        store_fact(spark, layout, gold.fact_order_items(orders, items), days)

    run_together(spark, [menu, outlet, dates, fact])


def store_fact(spark: SparkSession, layout: Layout, rows: DataFrame, days: list[date]) -> None:
    """Replace days of the fact, with the range of their keys noted and a filter of their keys beside them."""
    path = f"{layout.gold}/fact_order_items"

    def ranges(run: str, found: list[date]) -> dict[date, dict]:
        folders = [commits.run_folder(path, day, run) for day in found]
        return keysets.key_ranges(tables.read_folders(spark, path, FACT, folders), FACT_KEY) if folders else {}

    tables.write_days(rows, path, days, notes=ranges)
    held = commits.state(spark, path)
    counts = {day: held.days[day].notes["keys"] for day in held.filled(days)}
    stored = tables.read_day_files(spark, path, FACT, days, held=held)
    tables.write_days(keysets.day_filters(stored, FACT_KEY, counts), f"{layout.gold}/{FACT_KEYS}", days, aligned=True)


def repeated_fact_keys(spark: SparkSession, layout: Layout, days: list[date]) -> DataFrame:
    """Keys of the given days that the fact has more than once, in these days or in any other.

    Other days are opened only where their range of keys meets that of the new ones and their filter knows one of them.
    """
    path = f"{layout.gold}/fact_order_items"
    held = commits.state(spark, path)
    new = tables.read_day_files(spark, path, FACT, days, held=held)
    own = [held.days[day].notes for day in held.filled(days) if held.days[day].notes.get("low") is not None]
    if not own:
        return keysets.repeated_keys(new, None, FACT_KEY)
    others = {day: held.days[day].notes for day in held.filled() if day not in set(days)}
    near = keysets.meeting_days(others, min(n["low"] for n in own), max(n["high"] for n in own))
    if near:
        filters = tables.read_day_files(spark, f"{layout.gold}/{FACT_KEYS}", keysets.FILTERS, near)
        near = keysets.known_days(new, FACT_KEY, filters)
    old = tables.read_day_files(spark, path, FACT, near, held=held) if near else None
    return keysets.repeated_keys(new, old, FACT_KEY)


def read_fact(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_partitioned(spark, f"{layout.gold}/fact_order_items", FACT)


def run_tests(spark: SparkSession, layout: Layout, as_of: date, days: list[date] | None = None) -> DataFrame:
    """The tests of the star schema and its inputs: one row per test, one scan per table.

    With days, tables by day are read on these days and in the span of the tests that look at recent rows; no other
    folder is opened, so the cost of a run's tests does not grow with the lake; that no key of the days occurs in any
    other day is seen from what is kept beside the fact. Without days, everything is read.
    """
    read, own = partial(tables.read_day_files, spark), days
    if days is not None:
        days = sorted({*days, *lookback_days(as_of, RECENT_DAYS)})
    tested = {
        "stg_orders": read(f"{layout.silver}/orders", SILVER_ORDERS, days),
        "stg_order_items": read(f"{layout.silver}/order_items", ORDER_ITEMS, days),
        "snp_menu_master": read_history(spark, layout, "menu_master"),
        "snp_outlet_master": read_history(spark, layout, "outlet_master"),
        "fact_order_items": read(f"{layout.gold}/fact_order_items", FACT, days),
        "dim_date": spark.read.parquet(f"{layout.gold}/dim_date"),
        "dim_menu": spark.read.parquet(f"{layout.gold}/dim_menu"),
        "dim_outlet": spark.read.parquet(f"{layout.gold}/dim_outlet"),
    }
    found = checks.summary_of(tested, star_tests(recent(as_of, RECENT_DAYS)))
    if own is None:
        return found
    return found.unionByName(checks.result("unique_fact_item_id_over_all_days", repeated_fact_keys(spark, layout, own)))


def star_tests(fresh: Column | None = None) -> dict[str, checks.Check]:
    """The declared tests; fresh says which rows of the fact those look at that are scoped by days."""
    check = checks.Check
    return {
        "not_null_stg_orders_order_id": check("not_null", "stg_orders", "order_id"),
        "not_null_stg_order_items_item_id": check("not_null", "stg_order_items", "item_id"),
        "not_null_snp_menu_master_menu_id": check("not_null", "snp_menu_master", "menu_id"),
        "not_null_snp_outlet_master_outlet_id": check("not_null", "snp_outlet_master", "outlet_id"),
        "not_null_fact_item_id": check("not_null", "fact_order_items", "item_id", where=fresh),
        "not_null_dim_menu_menu_id": check("not_null", "dim_menu", "menu_id"),
        "not_null_dim_date_date": check("not_null", "dim_date", "date"),
        "not_null_dim_outlet_outlet_id": check("not_null", "dim_outlet", "outlet_id"),
        "unique_fact_item_id": check("unique", "fact_order_items", "item_id", where=fresh),
        "unique_dim_date_date": check("unique", "dim_date", "date"),
        "relationships_fact_order_date": check("relationships", "fact_order_items", "order_date", "dim_date", "date"),
    }


def source_freshness(spark: SparkSession, layout: Layout, now: str) -> DataFrame:
    """Age of the newest silver order at the given time; the other tables are exempt.

    A row lies in the day of its creation, so the last day that has rows is all that is read.
    """
    path = f"{layout.silver}/orders"
    orders = tables.read_day_files(spark, path, SILVER_ORDERS, tables.every_stored_day(spark, path)[-1:])
    return checks.freshness(orders, "created_at", now, "orders")


def freshness_test(spark: SparkSession, layout: Layout, now: str) -> DataFrame:
    """Freshness as a row of the test summary: a warning is no violation."""
    status = F.when(F.col("status") == "error", "fail").otherwise(F.col("status")).alias("status")
    stale = (F.col("status") == "error").cast("long").alias("violations")
    return source_freshness(spark, layout, now).select(F.lit("freshness_orders").alias("test_name"), stale, status)


def load_silver(spark: SparkSession, layout: Layout, days: list[date]) -> DataFrame:
    """Silver part of a run; returns the violations per day and rule."""
    masters = silver.load_masters(spark, layout)
    return silver.load_days(spark, layout, days, masters, fresh_dir(spark, "silver"))


def run_days(
    spark: SparkSession,
    source,
    layout: Layout,
    days: list[date],
    as_of: date | None = None,
    calendar_end: str = CALENDAR_END,
    normalize_tier: bool = False,
    catch_up: bool = False,
    database: str | None = None,
    now: str | None = None,
    test_everything: bool = False,
) -> DataFrame:
    """The daily chain over any days; returns the test summary.

    A backfill is the same plan with more days: there is no loop over them. Running it
    again gives the same state, and days that are not named stay as they are.
    calendar_end is the last day of dim_date; the fact's days must lie before it.
    catch_up adds the earlier days whose source rows have changed since they were stored, however long ago that was.
    database names the catalog tables that follow each run; now is the time freshness is measured at, if it is.
    Tests look at the days of the run, or with test_everything at the whole lake.
    """
    configure(spark)
    size_shuffles(spark, source.size_bytes())
    as_of = as_of or max(days)
    if catch_up:
        days = sorted({*days, *changes.late_days(spark, source, layout, max(days))})
    extract(spark, source, layout, days)
    raw = [f"{layout.bronze}/{name}" for name in TRANSACTIONS]
    folders = [folder for path in raw for folder in commits.state(spark, path).folders(path, days)]
    size_shuffles(spark, sum(stored_bytes(spark, folder) for folder in folders))
    masters = silver.load_masters(spark, layout)
    work = fresh_dir(spark, "run")
    try:
        silver.load_days(spark, layout, days, masters, work)
    finally:
        discard(spark, work)
    build_gold(spark, layout, days, masters, calendar_end, normalize_tier)
    if database:
        catalog.publish(spark, layout, database, days)
    results = run_tests(spark, layout, as_of, None if test_everything else days)
    return results.unionByName(freshness_test(spark, layout, now)) if now else results
