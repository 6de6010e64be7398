"""Restaurant tables derived from the TPC-H-like test tables, with every kind of bad row in them.

The frames are only plans; they are built once per session and folder and used by many queries.
"""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.dates import day_keys
from tillhouse.layout import days_between
from tillhouse.operators import quality
from tillhouse.schemas import AMOUNT, PRICE

FIRST_DAY = date(2025, 1, 1)
LAST_DAY = date(2027, 1, 10)
ALL_DAYS = days_between(FIRST_DAY, LAST_DAY)
SPREAD_DAYS = len(ALL_DAYS)


@cache
def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One frame per table: its files are listed and their footers read once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _first_day() -> Column:
    return F.lit(FIRST_DAY.isoformat()).cast("date")


def _order_day(key: str) -> Column:
    return F.date_add(_first_day(), (F.col(key) % SPREAD_DAYS).cast("int"))


@cache
def outlet_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = _raw(spark, sf_dir, "supplier"), _raw(spark, sf_dir, "nation")
    residue = F.col("s_suppkey") % 5
    tier = (
        F.when(residue == 0, "1").when(residue == 1, "2").when(residue == 2, "3")
        .when(residue == 3, "Tier 1").otherwise("Tier 2")
    )
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").cast("int").alias("outlet_id"),
        F.col("s_name").alias("outlet_name"),
        F.col("n_name").alias("city"),
        tier.alias("region_tier"),
        _first_day().alias("created_at"),
        _first_day().alias("updated_at"),
    )


@cache
def menu_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = 1000 * (3 + F.col("p_partkey") % 20)
    residue = F.col("p_partkey") % 5
    category = (
        F.when(residue == 0, "Coffee").when(residue == 1, "Non-Coffee").when(residue == 2, "Pastry")
        .when(residue == 3, "Heavy Meal").otherwise("Merch")
    )
    return _raw(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("menu_id"),
        F.col("p_name").alias("menu_name"),
        category.alias("category"),
        base.cast(PRICE).alias("base_price"),
        (base + 9000).cast(PRICE).alias("price_tier_1"),
        (base + 6000).cast(PRICE).alias("price_tier_2"),
        (base + 3000).cast(PRICE).alias("price_tier_3"),
        F.when(F.col("p_size") % 4 == 0, "true").otherwise("false").alias("is_promo_active"),
        _first_day().alias("updated_at"),
    )


@cache
def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan menus, off-tier prices and repeated item ids included."""
    extra = F.when(F.col("l_quantity") == 50, 1).otherwise(3000 * (F.col("l_linenumber") % 4))
    price = 1000 * (3 + F.col("l_partkey") % 20) + extra
    quantity = F.col("l_quantity").cast("int")
    return _raw(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_orderkey") % 97 == 0, -1).otherwise(F.col("l_partkey")).alias("menu_id"),
        quantity.alias("quantity"),
        price.cast(PRICE).alias("price_per_item"),
        (quantity * price).cast(AMOUNT).alias("subtotal"),
        _order_day("l_orderkey").alias("order_date"),
    )


@cache
def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong totals, orphan outlets, one busy cashier, odd payments and repeated orders included."""
    key = F.col("o_orderkey")
    # The day makes it a join on two columns, so the sums are shuffled again and adaptive
    # execution sees two shuffled sides: it can split an order that fills a partition.
    day = _order_day("o_orderkey").alias("created_at")
    sums = quality.order_totals(order_items(spark, sf_dir)).withColumnRenamed("order_id", "o_orderkey")
    # A day that cannot be NULL adds no filter to the items, so that their sums are shuffled once for this join and the rules.
    totals = sums.select("*", F.coalesce(_order_day("o_orderkey"), _first_day()).alias("created_at"))
    total = F.coalesce("calculated_total", F.lit(0)) + F.when(key % 20 == 0, 1).otherwise(0)
    priority = F.col("o_orderpriority")
    payment = (
        F.when(priority == "1-URGENT", "QRIS").when(priority == "2-HIGH", "Cash")
        .when(priority == "3-MEDIUM", "GoPay").when(priority == "5-LOW", "cash")
        .when(key % 2 == 0, "OVO")
    )
    copies = F.when(key % 1000 == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        _raw(spark, sf_dir, "orders")
        .select("*", day)
        .join(totals, ["o_orderkey", "created_at"], "left")
        .select(
            key.alias("order_id"),
            F.when(key % 101 == 0, -1).otherwise(F.col("o_custkey") % 10).cast("int").alias("outlet_id"),
            F.when(key % 5 == 0, 100).otherwise(101 + F.col("o_custkey") % 29).cast("int").alias("cashier_id"),
            total.try_cast(AMOUNT).alias("total_amount"),
            payment.alias("payment_method"),
            "created_at",
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four source tables."""
    return {
        "outlet_master": outlet_master(spark, sf_dir),
        "menu_master": menu_master(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir).drop("order_date"),
    }


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same with times instead of dates, as the till database has them."""
    return {
        name: df.select(
            *[
                F.col(field.name).cast("timestamp").alias(field.name)
                if field.dataType.typeName() == "date"
                else F.col(field.name)
                for field in df.schema
            ]
        )
        for name, df in tables(spark, sf_dir).items()
    }


@cache
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with status and day keys, all days as one batch."""
    rows = orders(spark, sf_dir)
    totals = quality.with_order_totals(rows, order_items(spark, sf_dir))
    return quality.with_status(totals).select(
        *rows.columns, "data_quality_status", *day_keys(F.col("created_at"))
    )


@cache
def silver_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = order_items(spark, sf_dir)
    return items.select("*", *day_keys(F.col("order_date"))).drop("order_date")


def second_menu(menu: DataFrame) -> DataFrame:
    """A later state of the menu: some rows gone, some dearer, some new."""
    stays = menu.filter(F.col("menu_id") % 50 != 7)
    dearer = F.col("menu_id") % 10 == 0
    changed = stays.withColumns(
        {
            "base_price": F.when(dearer, F.col("base_price") + 500).otherwise(F.col("base_price")).cast(PRICE),
            "updated_at": F.when(dearer, F.lit("2025-03-01").cast("date")).otherwise(F.col("updated_at")),
        }
    )
    added = menu.filter(F.col("menu_id") < 5).withColumns(
        {
            "menu_id": -100 - F.col("menu_id"),
            "updated_at": F.lit("2025-03-02").cast("date"),
        }
    )
    return changed.unionByName(added)


def second_outlets(outlets: DataFrame) -> DataFrame:
    """A later state of the outlets: some moved to tier 1, some gone, some new."""
    stays = outlets.filter(F.col("outlet_id") % 25 != 4)
    moved = F.col("outlet_id") % 4 == 1
    changed = stays.withColumns(
        {
            "region_tier": F.when(moved, "1").otherwise(F.col("region_tier")),
            "updated_at": F.when(moved, F.lit("2025-06-15").cast("date")).otherwise(F.col("updated_at")),
        }
    )
    added = outlets.filter(F.col("outlet_id") <= 3).withColumns(
        {
            "outlet_id": -100 - F.col("outlet_id"),
            "created_at": F.lit("2025-06-16").cast("date"),
            "updated_at": F.lit("2025-06-16").cast("date"),
        }
    )
    return changed.unionByName(added)
