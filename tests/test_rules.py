"""Edge rows of the rules, labels and tests."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import labels
from tillhouse.functions.dates import iso_weekday, recent, within
from tillhouse.operators import checks, history, quality
from tillhouse.schemas import ORDERS, ORDER_ITEMS


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def order(order_id, outlet=1, cashier=101, total="10.00", payment="Cash", at="2026-03-02 10:00:00"):
    amount = None if total is None else Decimal(total)
    return (order_id, outlet, cashier, amount, payment, datetime.fromisoformat(at))


def item(item_id, order_id, menu=1, quantity=1, price="10.00", subtotal=None):
    return (item_id, order_id, menu, quantity, Decimal(price), Decimal(subtotal or price))


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_ITEMS)


def values(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_lower_case_payments_are_invalid(spark):
    rows = orders(spark, order(1, payment="cash"), order(2, payment="credit_card"), order(3), order(4, payment=None))
    assert values(quality.invalid_payments(rows), "order_id") == [(1,), (2,)]


def test_exact_money(spark):
    rows = orders(spark, order(1, total="0.30"), order(2, total="0.31"), order(3, total=None), order(4))
    bought = items(spark, item(1, 1, price="0.10"), item(2, 1, price="0.20"), item(3, 2, price="0.30"), item(4, 3))
    checked = quality.with_status(quality.with_order_totals(rows, bought)).cache()
    assert values(checked, "order_id", "data_quality_status") == [
        (1, "valid"), (2, "MISMATCH TOTAL AMOUNT"), (3, "MISMATCH TOTAL AMOUNT"), (4, "MISMATCH TOTAL AMOUNT"),
    ]
    assert values(quality.order_discrepancies(checked), "order_id") == [(2,)]
    assert values(quality.orders_without_items(checked), "order_id") == [(4,)]


MENU_PRICES = "menu_id long, " + ", ".join(f"{name} decimal(12,2)" for name in quality.MENU_PRICES)


def test_unknown_menu_is_orphan_not_off_price(spark):
    menu = spark.createDataFrame(
        [(1, *[Decimal(p) for p in ("10", "12", "14", "16")])],
        MENU_PRICES,
    )
    rows = items(spark, item(1, 1), item(2, 1, price="16"), item(3, 1, price="11"), item(4, 1, menu=9), item(5, 1, menu=None))
    assert values(quality.invalid_prices(rows, menu), "item_id") == [(3,)]
    assert values(quality.orphans(rows, menu, "menu_id"), "item_id") == [(4,), (5,)]
    bad = quality.bad_items(rows, menu)
    assert values(quality.unknown_menu(bad), *rows.columns) == values(quality.orphans(rows, menu, "menu_id"), *rows.columns)
    assert values(quality.off_price(bad), "item_id") == [(3,)]


@pytest.mark.parametrize(("cashiers", "flagged"), [(1, 0), (10, 0), (11, 1)])
def test_outlier_needs_eleven_groups(spark, cashiers, flagged):
    rows = [order(n, cashier=n) for n in range(1, cashiers)] + [order(1000 + n, cashier=999) for n in range(500)]
    assert quality.cashier_outliers(orders(spark, *rows)).count() == flagged


def test_outliers_without_orders(spark):
    assert quality.cashier_outliers(spark.createDataFrame([], ORDERS)).count() == 0


def test_rule_counts_list_every_rule_for_clean_data(spark):
    rows, bought = orders(spark, order(1)), items(spark, item(1, 1))
    menu = spark.createDataFrame([(1, *[Decimal(10)] * 4)], MENU_PRICES)
    found = {"duplicate_orders": quality.duplicate_orders(rows), "anomaly_cashiers": quality.cashier_outliers(rows)}
    counts = quality.rule_counts(quality.with_order_totals(rows, bought), quality.bad_items(bought, menu), found)
    assert {row.violations for row in counts.collect()} == {0}
    assert counts.count() == 8


def test_labels(spark):
    df = spark.createDataFrame(
        [("Coffee", 10000, "true", "1"), ("Pastry", 10001, "false", "Tier 1"), ("Merch", 17001, None, None)],
        "category string, price int, promo string, tier string",
    )
    found = df.select(
        labels.category_group(F.col("category")),
        labels.price_segment(F.col("price")),
        labels.promo_status(F.col("promo")),
        labels.region_label(F.col("tier")),
        labels.region_label(F.col("tier"), strip_prefix=True),
    )
    assert [tuple(row) for row in found.collect()] == [
        ("Minuman", "Value", "Active", "Prime", "Prime"),
        ("Makanan", "Core", "Inactive", "Unknown", "Prime"),
        ("Lainnya", "Signature", "Inactive", "Unknown", "Unknown"),
    ]


def test_monday_is_one(spark):
    df = spark.sql("SELECT DATE '2026-03-02' AS d UNION ALL SELECT DATE '2026-03-08'")
    assert [row[0] for row in df.select(iso_weekday(F.col("d"))).collect()] == [1, 7]


def test_day_range_is_half_open(spark):
    rows = orders(spark, order(1, at="2026-03-01 23:59:59"), order(2, at="2026-03-02 00:00:00"),
                  order(3, at="2026-03-02 23:59:59.999"), order(4, at="2026-03-03 00:00:00"))
    day = date(2026, 3, 2)
    assert values(rows.filter(within(F.col("created_at"), day, day)), "order_id") == [(2,), (3,)]


def test_recent_partitions(spark):
    df = spark.createDataFrame([("2026", "02", "27"), ("2026", "02", "26")], "year string, month string, day string")
    assert df.filter(recent(date(2026, 3, 2))).collect()[0].day == "27"
    assert df.filter(recent(date(2026, 3, 2))).count() == 1


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert values(checks.unique(df, "k"), "k", "n_records") == [(1, 2)]
    assert checks.not_null(df, "k").count() == 2


def test_relationships_skip_missing_values(spark):
    child = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(3,), (3,), (4,)], "p int")
    assert values(checks.relationships(child, "k", parent, "p"), "k") == [(1,), (1,)]
    assert values(checks.unmatched(child, "k", parent, "p"), "k", "n_records") == [(1, 2)]


@pytest.mark.parametrize(
    ("as_of", "status"),
    [("2026-03-03 10:00:00", "pass"), ("2026-03-03 10:00:01", "warn"), ("2026-03-04 10:00:01", "error")],
)
def test_freshness(spark, as_of, status):
    assert checks.freshness(orders(spark, order(1)), "created_at", as_of, "orders").first().status == status


def test_freshness_of_nothing(spark):
    empty = spark.createDataFrame([], ORDERS)
    assert checks.freshness(empty, "created_at", "2026-03-03 10:00:00", "orders").first().status == "error"


MASTER = "menu_id int, name string, price int, updated_at timestamp"


def master(spark, *rows):
    return spark.createDataFrame([(k, n, p, datetime.fromisoformat(t)) for k, n, p, t in rows], MASTER)


def test_history_invariants(spark):
    loads = [
        master(spark, (1, "a", 10, "2026-01-01"), (2, "b", 20, "2026-01-01")),
        master(spark, (1, "a", 11, "2026-01-05"), (2, "b", 20, "2026-01-01"), (3, "c", 30, "2026-01-05")),
        master(spark, (1, "a", 12, "2026-01-09"), (3, "c", 99, "2026-01-05")),
    ]
    stored = history.first_load(loads[0], "menu_id")
    for load in loads[1:]:
        stored = history.merge(stored, load, "menu_id")
        again = history.merge(stored, load, "menu_id")
        assert again.exceptAll(stored).count() == 0 and stored.exceptAll(again).count() == 0

    assert history.current_rows(stored).groupBy("menu_id").count().filter("count > 1").count() == 0
    versions = values(stored, "menu_id", "price", F.to_date("valid_from").cast("string"), F.coalesce(F.to_date("valid_to").cast("string"), F.lit("open")))
    assert versions == [
        ("1", 10, "2026-01-01", "2026-01-05"),
        ("1", 11, "2026-01-05", "2026-01-09"),
        ("1", 12, "2026-01-09", "open"),
        ("2", 20, "2026-01-01", "open"),
        ("3", 30, "2026-01-05", "open"),
    ]
    assert {row.day for row in stored.collect()} == {"1", "5", "9"}


def test_repeated_master_key_gives_one_version(spark):
    load = master(spark, (1, "a", 10, "2026-01-01"), (1, "a", 11, "2026-01-02"))
    assert values(history.first_load(load, "menu_id"), "menu_id", "price") == [("1", 11)]


def test_stamp_on_change(spark):
    old = master(spark, (1, "a", 10, "2026-01-01"), (2, None, 20, "2026-01-01"))
    new = master(spark, (1, "a", 11, "2026-01-01"), (2, None, 20, "2026-01-01"), (3, "c", 30, "2026-01-01"))
    stamped = history.stamp_updated_at(old, new, "menu_id", "2026-02-02")
    assert values(stamped, "menu_id", F.to_date("updated_at").cast("string")) == [
        (1, "2026-02-02"), (2, "2026-01-01"), (3, "2026-02-02"),
    ]
