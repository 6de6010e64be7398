"""Raw to silver: typed Parquet for every row, bad rows copied to quarantine."""

from __future__ import annotations

import logging
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.layout import DAY_KEYS, Layout, day_values, lookback_days
from tillhouse.operators import quality
from tillhouse.schemas import (
    BAD_ITEMS,
    CASHIER_COUNTS,
    CHECKED_ORDERS,
    DUPLICATE_ORDERS,
    MALFORMED_ROWS,
    MASTERS,
    ORDER_ITEMS,
    ORDERS,
    RULE_COUNTS,
    SILVER_ORDERS,
    with_days,
)
from tillhouse.session import discard, run_together
from tillhouse.sources import bronze, commits, tables

log = logging.getLogger(__name__)

# Lines of the raw layer that could not be read as their table says.
MALFORMED = "malformed_rows"

# Orders per cashier and day; the moments of a day's counts are noted with it.
CASHIERS = "cashier_counts"

# Rules on groups of orders. Their rows are computed, those of other rules are picked from day files.
DUPLICATES = "duplicate_orders"
GROUP_RULES = {DUPLICATES: DUPLICATE_ORDERS, "anomaly_cashiers": CASHIER_COUNTS}


def load_masters(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Refresh both masters and return them as stored."""
    loaded = {}
    for name, schema in MASTERS.items():
        path = f"{layout.silver}/{name}"
        tables.write_table(bronze.read_master(spark, f"{layout.bronze}/{name}", schema), path)
        loaded[name] = tables.read_table(spark, path, schema)
    return loaded


def quarantine_frames(checked: DataFrame, bad_items: DataFrame, scope: list[str]) -> dict[str, DataFrame]:
    """Bad rows by quarantine table. checked holds the orders with total and status."""
    order_columns = [*ORDERS.fieldNames(), *DAY_KEYS]
    orders = checked.select(*order_columns)
    with_totals = checked.select(*order_columns, "calculated_total")
    return {
        "orphan_items": quality.unknown_menu(bad_items),
        "invalid_payments": quality.invalid_payments(orders),
        "invalid_prices": quality.off_price(bad_items),
        "anomaly_cashiers": quality.cashier_outliers(orders, scope),
        "orders_discrepancies": quality.order_discrepancies(with_totals),
    }


def malformed_rows(parsed: dict[str, DataFrame]) -> DataFrame:
    """Raw lines that did not fit, of tables that were read with rescue."""
    lines = [
        bronze.malformed_lines(rows).select(F.lit(name).alias("table_name"), bronze.RESCUED, *DAY_KEYS)
        for name, rows in parsed.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def load_days(
    spark: SparkSession, layout: Layout, days: list[date], masters: dict[str, DataFrame], work: str
) -> DataFrame:
    """Check and store any number of days in one go; returns violations per day and rule.

    The raw items are parsed once, into silver. The orders with item total and status, and
    the bad items, are written once to the working folder, day by day. Every later step
    is a scan of these files, and a lost executor costs a re-read, not a repeat of the joins.

    Lines that do not fit their table stay in silver with NULL where nothing could be read, as the raw layer's reader
    gives them, and go to quarantine as they are. The parse itself counts them: raw items are read again only when it
    has met some. All tables are read in the given days only, so no write has to look for rows of others.
    """
    if not days:
        raise ValueError("no days to load")
    outlets, menu = masters["outlet_master"], masters["menu_master"]

    raw_orders = bronze.read_transactions(spark, f"{layout.bronze}/orders", ORDERS, days, rescue=True)
    raw_items = bronze.read_transactions(spark, f"{layout.bronze}/order_items", ORDER_ITEMS, days, rescue=True)
    seen = Observation()
    parsed = raw_items.observe(seen, F.count(F.col(bronze.RESCUED)).alias("malformed")).drop(bronze.RESCUED)
    silver_items, silver_orders = f"{layout.silver}/order_items", f"{layout.silver}/orders"
    noted = tables.written_hashes(spark, silver_items, ORDER_ITEMS)

    def store_items() -> None:
        tables.write_days(parsed, silver_items, days, aligned=True, notes=noted, chosen=True)

    def store_duplicates() -> None:
        # one count of the ids serves the rule and the join below, which has to know ids with very many rows
        rows = quality.duplicate_orders(raw_orders, DAY_KEYS)
        tables.write_days(rows, f"{layout.quarantine}/{DUPLICATES}", days, chosen=True)

    run_together(spark, [store_items, store_duplicates])
    malformed_items = raw_items if seen.get["malformed"] else None
    items = tables.read_day_files(spark, silver_items, ORDER_ITEMS, days)
    duplicates = tables.read_day_files(spark, f"{layout.quarantine}/{DUPLICATES}", DUPLICATE_ORDERS, days)

    def kept_by_day(rows: DataFrame, name: str, schema: StructType) -> DataFrame:
        """Stored with a day's rows side by side: few files for many small days, several for a large one."""
        tables.write_table(rows.hint("rebalance", *DAY_KEYS), f"{work}/{name}")
        return tables.read_table(spark, f"{work}/{name}", with_days(schema))

    def check_orders() -> DataFrame:
        totals = quality.with_order_totals(raw_orders, items, DAY_KEYS, duplicates=duplicates)
        rows = quality.with_status(totals)
        return kept_by_day(rows.select(*CHECKED_ORDERS.fieldNames(), *DAY_KEYS), "orders", CHECKED_ORDERS)

    def check_items() -> DataFrame:
        rows = quality.bad_items(items, menu)
        return kept_by_day(rows.select(*BAD_ITEMS.fieldNames(), *DAY_KEYS), "bad_items", BAD_ITEMS)

    checked, bad_items = run_together(spark, [check_orders, check_items])

    def store_orders() -> None:
        rows = checked.select(*SILVER_ORDERS.fieldNames(), *DAY_KEYS)
        # the prints that a later run compares with the source are those of the source's columns
        noted = tables.written_hashes(spark, silver_orders, ORDERS)
        tables.write_days(rows, silver_orders, days, aligned=True, notes=noted, chosen=True)

    def store_counts() -> None:
        counts = quality.cashier_counts(checked, DAY_KEYS)
        tables.write_days(counts, f"{layout.silver}/{CASHIERS}", days, notes=day_moments, chosen=True)

    def day_moments(run: str, found: list[date]) -> dict[date, dict]:
        folders = [commits.run_folder(f"{layout.silver}/{CASHIERS}", day, run) for day in found]
        counts = tables.read_folders(spark, f"{layout.silver}/{CASHIERS}", CASHIER_COUNTS, folders)
        rows = quality.count_moments(counts, DAY_KEYS).collect()  # one per day
        return {date(int(r.year), int(r.month), int(r.day)): {"n": r.n, "mean": r["mean"], "m2": r.m2} for r in rows}

    def store_malformed() -> None:
        rows = malformed_rows({"orders": checked} | ({"order_items": malformed_items} if malformed_items else {}))
        tables.write_days(rows, f"{layout.quarantine}/{MALFORMED}", days, aligned=True, chosen=True)

    def store_bad(rule: str, rows: DataFrame) -> None:
        tables.write_days(rows, f"{layout.quarantine}/{rule}", days, aligned=rule not in GROUP_RULES, chosen=True)

    bad = quarantine_frames(checked, bad_items, DAY_KEYS)
    run_together(spark, [store_orders, store_counts, store_malformed, *(partial(store_bad, rule, rows) for rule, rows in bad.items())])

    found = {
        rule: tables.read_day_files(spark, f"{layout.quarantine}/{rule}", schema, days)
        for rule, schema in {**GROUP_RULES, MALFORMED: MALFORMED_ROWS}.items()
    }
    found["orphan_orders"] = quality.orphans(checked, outlets, "outlet_id")
    batches = spark.createDataFrame([day_values(day) for day in days], DAY_KEYS)
    rows = quality.rule_counts(checked, bad_items, found, DAY_KEYS, batches)
    tables.write_table(rows, f"{work}/rule_counts")
    discard(spark, f"{work}/orders")
    discard(spark, f"{work}/bad_items")

    counts = spark.read.schema(RULE_COUNTS).parquet(f"{work}/rule_counts")
    for row in counts.groupBy("rule").agg(F.sum("violations").alias("violations")).collect():
        log.warning("%s: %d violations", row.rule, row.violations)
    return counts


def cashier_outliers_in_window(spark: SparkSession, layout: Layout, day: date, days: int) -> DataFrame:
    """Cashiers of a day with outlying counts among those of the days up to it.

    Only the day's counts are read. What the other days contribute are the moments that are noted with them.
    """
    path = f"{layout.silver}/{CASHIERS}"
    held = commits.state(spark, path)
    window = held.filled(lookback_days(day, days - 1))
    noted = [(each, *(held.days[each].notes[name] for name in ("n", "mean", "m2"))) for each in window]
    moments = spark.createDataFrame(noted, "date date, n long, mean double, m2 double")
    counts = tables.read_day_files(spark, path, CASHIER_COUNTS, [day], held=held)
    counts = counts.select(F.make_date(*[F.col(key).cast("int") for key in DAY_KEYS]).alias("date"), *CASHIER_COUNTS.fieldNames())
    return quality.outliers_in_window(counts, moments, days)
