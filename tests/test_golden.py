"""Known counts of the sample tables at sf0.01."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse import samples
from tillhouse.operators import history
from tillhouse.plans import gold
from tillhouse.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def run(spark, name):
    return REGISTRY[name](spark, SF)


def by(df, column):
    return {row[column]: row["count"] for row in df.groupBy(column).count().collect()}


def test_tables(spark):
    counts = {row.table_name: row.row_count for row in run(spark, "table_row_counts").collect()}
    assert counts == {"outlet_master": 100, "menu_master": 2000, "orders": 15015, "order_items": 60000}


def test_rules(spark):
    assert {row.rule: row.violations for row in run(spark, "dq_summary").collect()} == {
        "orders_without_items": 257,
        "orders_discrepancies": 733,
        "orphan_items": 586,
        "orphan_orders": 149,
        "invalid_payments": 2998,
        "null_payments": 1519,
        "invalid_prices": 1156,
        "duplicate_orders": 15,
        "anomaly_cashiers": 1,
    }


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("dq_orders_without_items", 257),
        ("dq_order_discrepancies", 733),
        ("dq_orphan_items", 586),
        ("dq_orphan_orders", 149),
        ("dq_invalid_payments", 2998),
        ("dq_invalid_prices", 1156),
        ("dq_duplicate_orders", 15),
        ("dq_duplicate_orders_daily", 15),
        ("dq_anomaly_cashiers_daily", 88),
        ("fact_order_items_day", 78),
        ("test_unique", 11785),
    ],
)
def test_row_counts(spark, name, rows):
    assert run(spark, name).count() == rows


def test_status(spark):
    assert by(run(spark, "silver_orders"), "data_quality_status") == {"valid": 14025, "MISMATCH TOTAL AMOUNT": 990}


def test_outlier(spark):
    assert [tuple(row) for row in run(spark, "dq_anomaly_cashiers").collect()] == [(100, 3000)]


def test_fact(spark):
    row = run(spark, "fact_order_items").agg(F.count(F.lit(1)), F.sum("subtotal")).first()
    assert tuple(row) == (57014, Decimal("25255244050.00"))


def test_dimensions(spark):
    menu, outlet = run(spark, "dim_menu").cache(), run(spark, "dim_outlet").cache()
    assert by(outlet, "region_label") == {"Prime": 20, "Secondary": 20, "Tier 3": 20, "Unknown": 40}
    assert by(menu, "price_segment") == {"Value": 800, "Core": 700, "Signature": 500}
    assert by(menu, "category_group") == {"Makanan": 800, "Minuman": 800, "Lainnya": 400}
    assert by(menu, "promo_status") == {"Active": 461, "Inactive": 1539}
    assert outlet.columns == [
        "outlet_id", "outlet_name", "city", "region_tier", "region_label", "created_at", "updated_at",
        "row_start_date", "row_end_date", "is_current_active",
    ]


def test_normalized_tiers(spark):
    outlets = history.first_load(samples.outlet_master(spark, SF), "outlet_id")
    labels = by(gold.dim_outlet(outlets, normalize_tier=True), "region_label")
    assert labels == {"Prime": 40, "Secondary": 40, "Tier 3": 20}


def test_calendar(spark):
    days = gold.calendar(spark).cache()
    assert days.count() == 730
    first = days.orderBy("date").first()
    assert (str(first.date), first.day_name, first.week_of_year, first.day_of_week, first.month_name) == (
        "2025-01-01", "Wednesday", 1, 3, "January",
    )
    assert (first.is_weekend, first.year_month, first.quarter) == ("Weekday", "2025-01", 1)


def test_orders_after_the_calendar(spark):
    late = samples.orders(spark, SF).filter(F.col("created_at") > F.lit("2026-12-31").cast("date"))
    assert late.count() == 200


def test_second_load(spark):
    menu = samples.menu_master(spark, SF)
    later = samples.second_menu(menu)
    loaded = history.merge(history.first_load(menu, "menu_id"), later, "menu_id").cache()
    totals = loaded.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("valid_to").isNull()),
        F.count_if(F.col("valid_to").isNotNull()),
        F.countDistinct("menu_id"),
        F.sum("base_price"),
    ).first()
    assert tuple(totals) == (2205, 2005, 200, 2005, Decimal("26725000.00"))

    again = history.merge(loaded, later, "menu_id")
    assert again.exceptAll(loaded).count() == 0
    assert loaded.exceptAll(again).count() == 0
