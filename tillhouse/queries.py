"""The registered queries: every operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillhouse import samples
from tillhouse.functions.dates import day_keys, on_day, recent, with_day_keys
from tillhouse.functions.fixed_values import PROJECTED_YEARS
from tillhouse.layout import DAY_KEYS, Layout, day_values, lookback_days, projected_partitions
from tillhouse.operators import checks, history, quality
from tillhouse.plans import changes, gold, runs, silver
from tillhouse.schemas import (
    AMOUNT_SUM,
    BAD_ITEMS,
    CASHIER_COUNTS,
    DUPLICATE_ORDERS,
    FACT,
    MALFORMED_LINE,
    MALFORMED_ROWS,
    MENU_MASTER,
    ORDER_ITEMS,
    ORDERS,
    OUTLET_MASTER,
    SILVER_ORDERS,
)
from tillhouse.session import configure, fresh_dir, size_shuffles, stored_bytes
from tillhouse.sources import bronze, catalog, source, tables
from tillhouse.streaming import intake

RUN_DAY = date(2026, 5, 1)
TEST_DAY = date(2026, 12, 31)
FRESHNESS_TIME = "2027-01-11 12:00:00"

# Bytes of rows in a shuffle for each byte of the sample tables' compressed columns.
SHUFFLED_PER_STORED = 4

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


@cache
def _input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """The sample tables do not change, so their files are listed once."""
    return stored_bytes(spark, sf_dir)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        size_shuffles(spark, SHUFFLED_PER_STORED * _input_bytes(spark, sf_dir))
        return build(spark, sf_dir)

    REGISTRY[build.__name__] = run
    return build


def _dated(df: DataFrame) -> DataFrame:
    """Times as dates, as the samples have them."""
    return df.select(
        *[
            F.to_date(field.name).alias(field.name) if field.dataType.typeName() == "timestamp" else F.col(field.name)
            for field in df.schema
        ]
    )


def _layout(spark: SparkSession, name: str) -> Layout:
    return Layout.under(fresh_dir(spark, name))


def _source(spark: SparkSession, sf_dir: str) -> source.FrameSource:
    return source.FrameSource(samples.source_tables(spark, sf_dir))


# --- scans, sources, sinks ---------------------------------------------------------------


@query
def scan_source(spark, sf_dir):
    return source.as_text(_source(spark, sf_dir).table("order_items"))


@query
def extract_master_full(spark, sf_dir):
    return source.as_text(samples.menu_master(spark, sf_dir))


@query
def extract_outlet_full(spark, sf_dir):
    return source.as_text(samples.outlet_master(spark, sf_dir))


@query
def extract_orders_day(spark, sf_dir):
    return source.as_text(_dated(_source(spark, sf_dir).orders(RUN_DAY, RUN_DAY)))


@query
def extract_items_day(spark, sf_dir):
    rows = _source(spark, sf_dir).items(RUN_DAY, RUN_DAY)
    return source.as_text(rows.select(*ORDER_ITEMS.fieldNames()))


def _bronze_orders(spark, sf_dir, name):
    path = f"{fresh_dir(spark, name)}/orders"
    rows = _source(spark, sf_dir).table("orders")
    bronze.write_transactions(rows, ORDERS.fieldNames(), path, samples.ALL_DAYS)
    return path


@query
def bronze_csv_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    bronze.write_master(_source(spark, sf_dir).table("orders"), path)
    return _dated(bronze.read_master(spark, path, ORDERS))


@query
def bronze_partition_layout(spark, sf_dir):
    path = _bronze_orders(spark, sf_dir, "layout")
    rows = bronze.read_transactions(spark, path, ORDERS, samples.ALL_DAYS)
    folder = F.regexp_extract("_metadata.file_path", "(year=[0-9]+/month=[0-9]+/day=[0-9]+)/", 1)
    return rows.groupBy(folder.alias("partition_path")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def scan_csv_schema(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    bronze.write_master(_source(spark, sf_dir).table("order_items"), path)
    return bronze.read_master(spark, path, ORDER_ITEMS)


@query
def scan_csv_preview(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    bronze.write_master(_source(spark, sf_dir).table("order_items"), path)
    return bronze.preview(spark, path)


def _silver_master(spark, sf_dir, name, schema):
    layout = _layout(spark, "master")
    bronze.write_master(_source(spark, sf_dir).table(name), f"{layout.bronze}/{name}")
    tables.write_table(bronze.read_master(spark, f"{layout.bronze}/{name}", schema), f"{layout.silver}/{name}")
    return _dated(tables.read_table(spark, f"{layout.silver}/{name}", schema))


@query
def silver_master_load(spark, sf_dir):
    return _silver_master(spark, sf_dir, "menu_master", MENU_MASTER)


@query
def silver_outlet_load(spark, sf_dir):
    return _silver_master(spark, sf_dir, "outlet_master", OUTLET_MASTER)


def _in_time(silver: DataFrame) -> DataFrame:
    return silver.withColumn("created_at", F.col("created_at").cast("timestamp"))


@query
def silver_partition_overwrite(spark, sf_dir):
    """All days are stored, then one day is stored again with its payments in capitals."""
    path = fresh_dir(spark, "silver-orders")
    rows = _in_time(samples.silver_orders(spark, sf_dir))
    tables.write_days(rows, path, samples.ALL_DAYS)
    again = rows.filter(F.to_date("created_at") == F.lit(RUN_DAY))
    tables.write_days(again.withColumn("payment_method", F.upper("payment_method")), path, [RUN_DAY])
    return _dated(tables.read_partitioned(spark, path, SILVER_ORDERS))


@query
def quarantine_write(spark, sf_dir):
    """All days are checked, then one day is checked again after its rows were put right."""
    path = fresh_dir(spark, "invalid-payments")
    rows = with_day_keys(samples.source_tables(spark, sf_dir)["orders"], "created_at")
    tables.write_days(quality.invalid_payments(rows), path, samples.ALL_DAYS)
    fixed = rows.filter(F.to_date("created_at") == F.lit(RUN_DAY)).withColumn("payment_method", F.lit("Cash"))
    tables.write_days(quality.invalid_payments(fixed), path, [RUN_DAY])
    return _dated(tables.read_partitioned(spark, path, ORDERS))


@query
def scan_silver_partitioned(spark, sf_dir):
    path = fresh_dir(spark, "silver-items")
    tables.write_days(samples.silver_items(spark, sf_dir), path, samples.ALL_DAYS)
    return tables.read_partitioned(spark, path, ORDER_ITEMS)


@query
def catalog_external_table(spark, sf_dir):
    """Order counts and amounts per day, read through a catalog table over the stored files."""
    path = fresh_dir(spark, "silver-orders")
    rows = _in_time(samples.silver_orders(spark, sf_dir))
    tables.write_days(rows, path, samples.ALL_DAYS)
    name = "sample_silver_orders"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    catalog.create_external_table(spark, name, SILVER_ORDERS, path, by_day=True)
    catalog.register_days(spark, name, path)
    return (
        spark.table(name)
        .groupBy(*DAY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_amount").cast("decimal(24,2)").alias("total_amount"),
        )
    )


@query
def partition_projection(spark, sf_dir):
    """Every partition the projection rules allow, with the orders found in it."""
    allowed = spark.createDataFrame(projected_partitions(*PROJECTED_YEARS), "year string, month string, day string")
    found = (
        samples.orders(spark, sf_dir)
        .groupBy(*day_keys(F.col("created_at")))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )
    return allowed.join(found, DAY_KEYS, "left").select(
        *DAY_KEYS, F.coalesce("order_count", F.lit(0)).alias("order_count")
    )


@query
def stg_orders(spark, sf_dir):
    samples.silver_orders(spark, sf_dir).createOrReplaceTempView("stg_orders")
    return spark.table("stg_orders")


@query
def stg_order_items(spark, sf_dir):
    samples.silver_items(spark, sf_dir).createOrReplaceTempView("stg_order_items")
    return spark.table("stg_order_items")


def _fact(spark, sf_dir):
    return gold.fact_order_items(samples.silver_orders(spark, sf_dir), samples.silver_items(spark, sf_dir))


@query
def fact_incremental_overwrite(spark, sf_dir):
    """The whole fact is stored, then one day is rebuilt without the orders of cashier 100."""
    path = fresh_dir(spark, "fact")
    orders = _in_time(samples.silver_orders(spark, sf_dir))
    items = samples.silver_items(spark, sf_dir)
    fact = gold.fact_order_items(orders, items)
    tables.write_days(fact, path, samples.ALL_DAYS)
    rest = orders.filter(F.col("cashier_id") != 100)
    tables.write_days(gold.fact_for_day(rest, items, RUN_DAY), path, [RUN_DAY])
    return _dated(tables.read_partitioned(spark, path, FACT))


@query
def insert_if_absent(spark, sf_dir):
    """The orders of 2025 are stored, then all orders arrive, twice."""
    path = fresh_dir(spark, "orders")
    rows = samples.orders(spark, sf_dir)
    stored = rows.filter(F.col("created_at") < F.lit("2026-01-01").cast("date"))
    tables.write_keyed(stored.distinct(), path, "order_id")
    tables.insert_if_absent(rows, path, "order_id")
    tables.insert_if_absent(rows, path, "order_id")
    return tables.read_keyed(spark, path, rows.schema)


# --- data quality ------------------------------------------------------------------------


def _orders_with_totals(spark, sf_dir):
    return quality.with_order_totals(samples.orders(spark, sf_dir), samples.order_items(spark, sf_dir))


def _items(spark, sf_dir):
    return samples.order_items(spark, sf_dir).drop("order_date")


@query
def dq_orders_without_items(spark, sf_dir):
    return quality.orders_without_items(_orders_with_totals(spark, sf_dir)).drop("calculated_total")


@query
def dq_order_discrepancies(spark, sf_dir):
    return quality.order_discrepancies(_orders_with_totals(spark, sf_dir))


@query
def dq_orphan_items(spark, sf_dir):
    return quality.orphans(_items(spark, sf_dir), samples.menu_master(spark, sf_dir), "menu_id")


@query
def dq_orphan_orders(spark, sf_dir):
    return quality.orphans(samples.orders(spark, sf_dir), samples.outlet_master(spark, sf_dir), "outlet_id")


@query
def dq_invalid_payments(spark, sf_dir):
    return quality.invalid_payments(samples.orders(spark, sf_dir))


@query
def dq_invalid_prices(spark, sf_dir):
    return quality.invalid_prices(_items(spark, sf_dir), samples.menu_master(spark, sf_dir))


@query
def dq_duplicate_orders(spark, sf_dir):
    return quality.duplicate_orders(samples.orders(spark, sf_dir))


@query
def dq_duplicate_orders_daily(spark, sf_dir):
    rows = with_day_keys(samples.orders(spark, sf_dir), "created_at")
    return quality.duplicate_orders(rows, DAY_KEYS)


@query
def dq_anomaly_cashiers(spark, sf_dir):
    return quality.cashier_outliers(samples.orders(spark, sf_dir))


@query
def dq_anomaly_cashiers_daily(spark, sf_dir):
    rows = with_day_keys(samples.orders(spark, sf_dir), "created_at")
    return quality.cashier_outliers(rows, DAY_KEYS)


@query
def dq_anomaly_cashiers_window(spark, sf_dir):
    """Cashiers with outlying counts among those of four weeks, from a day's counts and the moments of each day."""
    rows = samples.orders(spark, sf_dir).withColumn("date", F.to_date("created_at"))
    counts = quality.cashier_counts(rows, ["date"])
    return quality.outliers_in_window(counts, quality.count_moments(counts, ["date"]), 28)


@query
def run_anomaly_cashiers_window(spark, sf_dir):
    """The same for the last of ten stored days, from the tables that runs leave: no order is read for it."""
    layout = _layout(spark, "window")
    days = lookback_days(RUN_DAY, 9)
    runs.extract(spark, _source(spark, sf_dir), layout, days)
    runs.load_silver(spark, layout, days)
    return silver.cashier_outliers_in_window(spark, layout, RUN_DAY, 10)


@query
def dq_anomaly_outlet_cashiers(spark, sf_dir):
    return quality.cashier_outliers(samples.orders(spark, sf_dir), group_cols=["outlet_id", "cashier_id"])


@query
def silver_orders(spark, sf_dir):
    return quality.with_status(_orders_with_totals(spark, sf_dir)).drop("calculated_total")


@query
def silver_order_items(spark, sf_dir):
    return _items(spark, sf_dir)


@query
def dq_summary(spark, sf_dir):
    orders, items = samples.orders(spark, sf_dir), _items(spark, sf_dir)
    found = {
        "orphan_orders": quality.orphans(orders, samples.outlet_master(spark, sf_dir), "outlet_id"),
        "duplicate_orders": quality.duplicate_orders(orders),
        "anomaly_cashiers": quality.cashier_outliers(orders),
    }
    bad = quality.bad_items(items, samples.menu_master(spark, sf_dir))
    return quality.rule_counts(quality.with_order_totals(orders, items), bad, found)


@query
def dq_sample_bad_rows(spark, sf_dir):
    bad = quality.invalid_prices(_items(spark, sf_dir), samples.menu_master(spark, sf_dir))
    return quality.sample_rows(bad, ["item_id", "menu_id", "price_per_item", *quality.MENU_PRICES])


# --- joins and aggregates ----------------------------------------------------------------


@query
def join_orders_item_totals(spark, sf_dir):
    return _orders_with_totals(spark, sf_dir)


@query
def join_items_menu(spark, sf_dir):
    return quality.with_menu_prices(_items(spark, sf_dir), samples.menu_master(spark, sf_dir))


@query
def agg_order_item_totals(spark, sf_dir):
    return quality.order_totals(samples.order_items(spark, sf_dir))


@query
def agg_cashier_tx_count(spark, sf_dir):
    return quality.cashier_counts(samples.orders(spark, sf_dir))


@query
def agg_cashier_stats(spark, sf_dir):
    stats = quality.cashier_stats(quality.cashier_counts(samples.orders(spark, sf_dir)))
    return stats.select(*[F.col(name).cast("decimal(18,4)").alias(name) for name in stats.columns])


@query
def agg_max_id(spark, sf_dir):
    return tables.max_id(samples.orders(spark, sf_dir), "order_id")


@query
def partition_columns(spark, sf_dir):
    rows = with_day_keys(samples.orders(spark, sf_dir).select("order_id", "created_at"), "created_at")
    text = F.format_string("year=%s/month=%s/day=%s", *DAY_KEYS)
    return rows.withColumn("partition_path", text)


@query
def date_range(spark, sf_dir):
    days = gold.date_rows(gold.date_span(samples.orders(spark, sf_dir), "created_at"))
    return days.select(F.col("date").cast("string").alias("run_date"))


# --- history and star schema -------------------------------------------------------------


def _menu_history(spark, sf_dir):
    menu = samples.menu_master(spark, sf_dir)
    return history.merge(history.first_load(menu, "menu_id"), samples.second_menu(menu), "menu_id")


def _outlet_history(spark, sf_dir):
    outlets = samples.outlet_master(spark, sf_dir)
    return history.merge(history.first_load(outlets, "outlet_id"), samples.second_outlets(outlets), "outlet_id")


@query
def scd2_initial(spark, sf_dir):
    return history.first_load(samples.menu_master(spark, sf_dir), "menu_id")


@query
def scd2_menu(spark, sf_dir):
    return _menu_history(spark, sf_dir)


@query
def scd2_outlet(spark, sf_dir):
    return _outlet_history(spark, sf_dir)


@query
def stamp_updated_at(spark, sf_dir):
    menu = samples.menu_master(spark, sf_dir)
    arriving = samples.second_menu(menu).withColumn("updated_at", F.lit("2025-01-01").cast("date"))
    return history.stamp_updated_at(menu, arriving, "menu_id", "2025-04-01")


@query
def dim_date(spark, sf_dir):
    """The calendar of the days the orders cover."""
    return gold.dim_date(gold.date_rows(gold.date_span(samples.orders(spark, sf_dir), "created_at")))


@query
def dim_menu(spark, sf_dir):
    return gold.dim_menu(history.first_load(samples.menu_master(spark, sf_dir), "menu_id"))


@query
def dim_menu_versions(spark, sf_dir):
    return gold.dim_menu(_menu_history(spark, sf_dir))


@query
def dim_outlet(spark, sf_dir):
    return gold.dim_outlet(history.first_load(samples.outlet_master(spark, sf_dir), "outlet_id"))


@query
def dim_outlet_versions(spark, sf_dir):
    return gold.dim_outlet(_outlet_history(spark, sf_dir), normalize_tier=True)


@query
def fact_order_items(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def fact_order_items_day(spark, sf_dir):
    return gold.fact_for_day(samples.silver_orders(spark, sf_dir), samples.silver_items(spark, sf_dir), RUN_DAY)


# --- data tests --------------------------------------------------------------------------


@query
def test_not_null(spark, sf_dir):
    return checks.not_null(samples.orders(spark, sf_dir), "payment_method")


@query
def test_unique(spark, sf_dir):
    return checks.unique(samples.order_items(spark, sf_dir), "item_id")


@query
def test_unique_recent(spark, sf_dir):
    return checks.unique(_fact(spark, sf_dir).filter(recent(TEST_DAY)), "item_id")


@query
def test_relationships(spark, sf_dir):
    return checks.relationships(_fact(spark, sf_dir), "order_date", gold.calendar(spark), "date")


@query
def test_freshness(spark, sf_dir):
    return checks.freshness(samples.orders(spark, sf_dir), "created_at", FRESHNESS_TIME, "orders")


@query
def test_column_count(spark, sf_dir):
    return checks.column_counts(samples.tables(spark, sf_dir))


@query
def table_row_counts(spark, sf_dir):
    return checks.row_counts(samples.tables(spark, sf_dir))


@query
def test_constraints(spark, sf_dir):
    return checks.constraints(samples.tables(spark, sf_dir))


@query
def test_summary(spark, sf_dir):
    orders, items = samples.silver_orders(spark, sf_dir), samples.silver_items(spark, sf_dir)
    menu = history.first_load(samples.menu_master(spark, sf_dir), "menu_id")
    outlets = history.first_load(samples.outlet_master(spark, sf_dir), "outlet_id")
    return checks.summary_of(
        {
            "stg_orders": orders,
            "stg_order_items": items,
            "snp_menu_master": menu,
            "snp_outlet_master": outlets,
            "fact_order_items": gold.fact_order_items(orders, items),
            "dim_date": gold.calendar(spark),
            "dim_menu": gold.dim_menu(menu),
            "dim_outlet": gold.dim_outlet(outlets),
        },
        runs.star_tests(),
    )


# --- runs --------------------------------------------------------------------------------


@query
def silver_day_run(spark, sf_dir):
    """One day from source to silver: violations per rule."""
    layout = _layout(spark, "silver-day")
    runs.extract(spark, _source(spark, sf_dir), layout, [RUN_DAY])
    return runs.load_silver(spark, layout, [RUN_DAY])


@query
def backfill_run(spark, sf_dir):
    """All days from source to silver in one run: violations per day and rule."""
    layout = _layout(spark, "backfill")
    runs.extract(spark, _source(spark, sf_dir), layout, samples.ALL_DAYS)
    return runs.load_silver(spark, layout, samples.ALL_DAYS)


@query
def late_lookback(spark, sf_dir):
    """Three days are loaded before their GoPay orders have arrived, then looked back on."""
    layout = _layout(spark, "lookback")
    days = lookback_days(RUN_DAY)
    complete = samples.source_tables(spark, sf_dir)
    late = F.coalesce(F.col("payment_method") == "GoPay", F.lit(False))
    early = source.FrameSource({**complete, "orders": complete["orders"].filter(~late)})
    runs.extract(spark, early, layout, days)
    runs.load_silver(spark, layout, days)
    runs.extract(spark, source.FrameSource(complete), layout, days)
    runs.load_silver(spark, layout, days)
    return _dated(tables.read_partitioned(spark, f"{layout.silver}/orders", SILVER_ORDERS))


@query
def backfill_gap_days(spark, sf_dir):
    """Three days are stored without their GoPay orders, then the first and the last are run again with all."""
    layout = _layout(spark, "gap")
    days = lookback_days(RUN_DAY)
    complete = samples.source_tables(spark, sf_dir)
    late = F.coalesce(F.col("payment_method") == "GoPay", F.lit(False))
    early = source.FrameSource({**complete, "orders": complete["orders"].filter(~late)})
    runs.extract(spark, early, layout, days)
    runs.load_silver(spark, layout, days)
    again = [days[0], days[2]]
    runs.extract(spark, source.FrameSource(complete), layout, again)
    runs.load_silver(spark, layout, again)
    return _dated(tables.read_partitioned(spark, f"{layout.silver}/orders", SILVER_ORDERS))


@query
def run_dim_menu(spark, sf_dir):
    """The menu dimension as a run stores it."""
    return _stored_dimension(spark, sf_dir, "dim_menu")


@query
def run_dim_outlet(spark, sf_dir):
    """The outlet dimension as a run stores it."""
    return _stored_dimension(spark, sf_dir, "dim_outlet")


def _stored_dimension(spark, sf_dir, name):
    layout = _layout(spark, "dims")
    runs.run_days(spark, _source(spark, sf_dir), layout, [RUN_DAY])
    return _dated(spark.read.parquet(f"{layout.gold}/{name}"))


@query
def daily_run(spark, sf_dir):
    """One day from source to gold: the stored fact."""
    layout = _layout(spark, "daily")
    runs.run_days(spark, _source(spark, sf_dir), layout, [RUN_DAY])
    return _dated(runs.read_fact(spark, layout))


@query
def unique_over_days(spark, sf_dir):
    """Items of one day that the stored fact has more than once, when that day also holds late copies of items of others."""
    layout = _layout(spark, "unique")
    orders, items = _in_time(samples.silver_orders(spark, sf_dir)), samples.silver_items(spark, sf_dir)
    fact = gold.fact_order_items(orders, items)
    runs.store_fact(spark, layout, fact, samples.ALL_DAYS)
    # what is written again comes from the stored fact: its files stay while its day is replaced
    stored = runs.read_fact(spark, layout)
    year, month, day = day_values(RUN_DAY)
    late = stored.filter(F.col("item_id") % 1000 == 11).withColumns({"year": F.lit(year), "month": F.lit(month), "day": F.lit(day)})
    own = stored.filter(on_day(RUN_DAY))
    runs.store_fact(spark, layout, own.unionByName(late), [RUN_DAY])
    return runs.repeated_fact_keys(spark, layout, [RUN_DAY])


@query
def csv_odd_text(spark, sf_dir):
    """Payment methods with quotes, backslashes, line breaks, blanks at both ends, or reading like NULL, through the raw layer."""
    path = f"{fresh_dir(spark, 'odd')}/orders"
    rows = _source(spark, sf_dir).table("orders")
    wrapped = F.concat(F.lit(" \t "), "payment_method", F.lit('\n"x\\n", \r\\ \t '))
    odd = rows.withColumn("payment_method", F.when(F.col("order_id") % 7 == 0, "<nil>").otherwise(wrapped))
    bronze.write_transactions(odd, ORDERS.fieldNames(), path, samples.ALL_DAYS)
    return _dated(bronze.read_transactions(spark, path, ORDERS, samples.ALL_DAYS).drop(*DAY_KEYS))


@query
def dq_malformed_rows(spark, sf_dir):
    """Lines of the raw layer that do not fit: amounts, outlets and times that are none."""
    path = f"{fresh_dir(spark, 'malformed')}/orders"
    rows = with_day_keys(_source(spark, sf_dir).table("orders"), "created_at")
    text = source.as_text(rows.withColumns({"order_id": F.col("order_id"), "outlet_id": F.col("outlet_id").cast("string")}))
    kind = F.col("order_id") % 50
    broken = {"total_amount": (3, "oops"), "outlet_id": (11, "x1"), "created_at": (17, "2026-13-45 00:00:00")}
    text = text.withColumns({name: F.when(kind == k, value).otherwise(F.col(name)) for name, (k, value) in broken.items()})
    tables.write_days(text, path, samples.ALL_DAYS, fmt="csv", options=bronze.CSV_OPTIONS)
    return bronze.malformed(spark, path, ORDERS, samples.ALL_DAYS)


@query
def changed_days(spark, sf_dir):
    """Nine of ten days are stored: the first without its GoPay orders, the sixth with payments in capitals, the eighth not at all."""
    layout = _layout(spark, "changed")
    days = lookback_days(RUN_DAY, 9)
    complete = samples.source_tables(spark, sf_dir)
    on = F.to_date("created_at")
    late = (on == F.lit(days[0])) & F.coalesce(F.col("payment_method") == "GoPay", F.lit(False))
    method = F.when(on == F.lit(days[5]), F.upper("payment_method")).otherwise(F.col("payment_method"))
    early = source.FrameSource({**complete, "orders": complete["orders"].filter(~late).withColumn("payment_method", method)})
    stored = days[:7] + days[8:]
    runs.extract(spark, early, layout, stored)
    runs.load_silver(spark, layout, stored)
    return changes.changed_days(spark, source.FrameSource(complete), layout, days[0], RUN_DAY)


@query
def run_quarantine(spark, sf_dir):
    """The quarantine tables as a run over three days stores them, and what is wrong with each row."""
    layout = _layout(spark, "quarantine")
    days = lookback_days(RUN_DAY)
    runs.extract(spark, _source(spark, sf_dir), layout, days)
    runs.load_silver(spark, layout, days)
    totals = StructType([*ORDERS.fields, StructField("calculated_total", AMOUNT_SUM)])
    prices = StructType([field for field in BAD_ITEMS if field.name not in ("price_valid", "menu_known")])
    kept = {
        "orphan_items": (ORDER_ITEMS, "item_id", "menu_id"),
        "invalid_payments": (ORDERS, "order_id", "payment_method"),
        "invalid_prices": (prices, "item_id", "price_per_item"),
        "duplicate_orders": (DUPLICATE_ORDERS, "order_id", "count"),
        "anomaly_cashiers": (CASHIER_COUNTS, "cashier_id", "tx_count"),
        "orders_discrepancies": (totals, "order_id", "calculated_total"),
        "malformed_rows": (MALFORMED_ROWS, "table_name", MALFORMED_LINE.name),
    }
    found = [
        tables.read_partitioned(spark, f"{layout.quarantine}/{rule}", schema).select(
            F.lit(rule).alias("rule"), F.col(key).cast("string").alias("row_key"), F.col(value).cast("string").alias("value"), *DAY_KEYS
        )
        for rule, (schema, key, value) in kept.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def run_history(spark, sf_dir):
    """The menu's history as two loads store it."""
    layout = _layout(spark, "history")
    menu = samples.menu_master(spark, sf_dir)
    runs.refresh_history(spark, layout, "menu_master", menu)
    return runs.refresh_history(spark, layout, "menu_master", samples.second_menu(menu))


@query
def stream_ledger(spark, sf_dir):
    """What has been landed, by day, after all days arrived and one of them once more, without its QRIS orders."""
    path = _bronze_orders(spark, sf_dir, "ledger")
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "stream-checkpoint")
    intake.ingest_arrivals(spark, path, ORDERS, landed, checkpoint)
    rest = _source(spark, sf_dir).orders(RUN_DAY, RUN_DAY).filter("payment_method IS NULL OR payment_method <> 'QRIS'")
    bronze.write_transactions(rest, ORDERS.fieldNames(), path, [RUN_DAY])
    intake.ingest_arrivals(spark, path, ORDERS, landed, checkpoint)
    return intake.ledger(spark, landed).select("day", "row_count")


@query
def stream_rerun_day(spark, sf_dir):
    """All days arrive, then one day arrives again with its payments in capitals."""
    path = _bronze_orders(spark, sf_dir, "stream")
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "stream-checkpoint")
    intake.ingest_arrivals(spark, path, ORDERS, landed, checkpoint)
    again = _source(spark, sf_dir).orders(RUN_DAY, RUN_DAY).withColumn("payment_method", F.upper("payment_method"))
    bronze.write_transactions(again, ORDERS.fieldNames(), path, [RUN_DAY])
    intake.ingest_arrivals(spark, path, ORDERS, landed, checkpoint)
    return _dated(intake.read_landed(spark, landed, ORDERS))


@query
def stream_bronze_ingest(spark, sf_dir):
    path = _bronze_orders(spark, sf_dir, "stream")
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "stream-checkpoint")
    intake.ingest_arrivals(spark, path, ORDERS, landed, checkpoint, days_per_batch=250)
    return _dated(intake.read_landed(spark, landed, ORDERS))
