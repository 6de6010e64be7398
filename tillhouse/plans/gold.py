"""Star schema: calendar, menu and outlet dimensions, item-grain fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.dates import in_days, iso_weekday, on_day, weekend_label, year_month
from tillhouse.functions.fixed_values import CALENDAR_END, CALENDAR_START, STATUS_VALID
from tillhouse.functions.labels import category_group, price_segment, promo_status, region_label
from tillhouse.layout import DAY_KEYS


def date_rows(bounds: DataFrame) -> DataFrame:
    """Every day from first to last, both included, of a one-row frame (first, last)."""
    return bounds.select(
        F.explode(F.sequence(F.col("first"), F.col("last"), F.expr("INTERVAL 1 DAY"))).alias("date")
    )


def date_span(df: DataFrame, column: str) -> DataFrame:
    """Bounds of the days a table covers."""
    return df.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))


def dim_date(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        weekend_label(day).alias("is_weekend"),
        year_month(day).alias("year_month"),
    )


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return dim_date(date_rows(bounds))


def dim_menu(history: DataFrame) -> DataFrame:
    return history.select(
        "menu_id",
        "menu_name",
        "category",
        category_group(F.col("category")).alias("category_group"),
        "base_price",
        "price_tier_1",
        "price_tier_2",
        "price_tier_3",
        price_segment(F.col("base_price")).alias("price_segment"),
        promo_status(F.col("is_promo_active")).alias("promo_status"),
        "updated_at",
        *_validity(),
    )


def dim_outlet(history: DataFrame, normalize_tier: bool = False) -> DataFrame:
    """Tiers count only when written as a bare number, unless normalize_tier drops a leading 'Tier '."""
    return history.select(
        "outlet_id",
        "outlet_name",
        "city",
        "region_tier",
        region_label(F.col("region_tier"), normalize_tier).alias("region_label"),
        "created_at",
        "updated_at",
        *_validity(),
    )


def _validity() -> list:
    return [
        F.col("valid_from").alias("row_start_date"),
        F.col("valid_to").alias("row_end_date"),
        F.col("valid_to").isNull().alias("is_current_active"),
    ]


def fact_order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Items of valid orders with their order's attributes; the partition is the item's."""
    order_columns = ["outlet_id", "cashier_id", "total_amount", "payment_method", "created_at"]
    valid = orders.filter(F.col("data_quality_status") == STATUS_VALID).select("order_id", *order_columns)
    joined = items.join(valid, "order_id")
    return joined.select(
        "item_id",
        "order_id",
        "menu_id",
        "quantity",
        "price_per_item",
        "subtotal",
        "outlet_id",
        "cashier_id",
        "total_amount",
        "payment_method",
        F.to_date("created_at").alias("order_date"),
        "created_at",
        *DAY_KEYS,
    )


def fact_for_day(orders: DataFrame, items: DataFrame, day: date) -> DataFrame:
    """One day of the fact. An item lies in its order's day, so both sides are pruned to it."""
    return fact_order_items(orders.filter(on_day(day)), items.filter(on_day(day)))


def fact_for_days(orders: DataFrame, items: DataFrame, days: list[date]) -> DataFrame:
    return fact_order_items(orders.filter(in_days(days)), items.filter(in_days(days)))
