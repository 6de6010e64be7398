"""Joins whose left side has a third of its rows on one key."""

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import quality
from tillhouse.operators.skew import hot_keys, hot_of, split_hot_join

ROWS = 30_000


@pytest.fixture(scope="module")
def left(spark):
    """A third of the rows on key 7, a sixth without key, the rest on keys of their own; many exact copies."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 6 == 1, F.lit(None)).otherwise(n)
    return spark.range(0, ROWS, 1, 12).select(key.cast("long").alias("k"), (n % 5).alias("v"))


@pytest.fixture(scope="module")
def right(spark):
    return spark.range(0, ROWS, 2, 6).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(
        spark.sql("SELECT 7L, 70L")
    )


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_keys(left):
    found = {row._hot_k: row._splits for row in hot_keys(left, ["k"], 1000).collect()}
    assert found == {7: 10, None: 5}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows_per_split", [100, 1000, 10**9])
def test_equals_plain_join(left, right, how, rows_per_split):
    plain = left.join(right, "k", how)
    split = split_hot_join(left, right, ["k"], how, rows_per_split)
    assert split.columns == plain.columns
    assert same(plain, split)


def test_repeated_right_rows(left, right):
    twice = right.union(right)
    assert same(left.join(twice, "k"), split_hot_join(left, twice, ["k"], "inner", 500))


def test_several_keys(spark, left, right):
    wide_left = left.withColumn("day", F.when(F.col("v") > 2, "a").otherwise("b"))
    wide_right = right.crossJoin(spark.createDataFrame([("a",), ("b",)], "day string"))
    plain = wide_left.join(wide_right, ["day", "k"], "left").select("k", "v", "day", "w")
    split = split_hot_join(wide_left, wide_right, ["day", "k"], "left", 500).select("k", "v", "day", "w")
    assert same(plain, split)


def test_hot_keys_from_counts(left, right):
    """Keys counted for another purpose, of which those that occur once are missing, salt the same keys."""
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    hot = hot_of(counts, ["k"], "n", 1000)
    assert {row._hot_k: row._splits for row in hot.collect()} == {7: 10, None: 5}
    assert same(left.join(right, "k", "left"), split_hot_join(left, right, ["k"], "left", 1000, hot))


def test_hot_rows_are_spread(spark, left, right):
    """No task gets the whole hot key, although most of its rows are exact copies."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(df):
            per_task = df.filter("k = 7").groupBy(F.spark_partition_id().alias("p")).count()
            return per_task.agg(F.max("count")).first()[0]

        assert largest(left.join(right, "k", "left")) == ROWS // 3
        assert largest(split_hot_join(left, right, ["k"], "left", 500)) < ROWS // 3 // 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_totals_of_hot_orders(spark):
    """One order repeated many times, one order with a third of all items, orders without id."""
    orders = spark.range(3000).select(
        F.when(F.col("id") < 1000, 5).when(F.col("id") < 1500, None).otherwise(F.col("id")).cast("long").alias("order_id"),
        F.lit(100).cast("decimal(14,2)").alias("total_amount"),
    )
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("long").alias("order_id"),
        F.lit("0.10").cast("decimal(14,2)").alias("subtotal"),
    )
    checked = quality.with_status(quality.with_order_totals(orders, items, rows_per_split=100)).cache()
    assert checked.count() == 3000
    hot = checked.filter("order_id = 5").groupBy("calculated_total", "data_quality_status").count().collect()
    assert [(str(row[0]), row[1], row[2]) for row in hot] == [("100.10", "MISMATCH TOTAL AMOUNT", 1000)]
    assert checked.filter("order_id IS NULL AND calculated_total IS NULL").count() == 500


@pytest.fixture
def tiny_partitions(spark):
    """Shuffled joins only, and every partition above a few kilobytes counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def splits_skew(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_items(spark, tmp_path):
    """A third of the items belong to one order and one menu; every order has one row."""
    n = F.col("id")
    items = spark.range(0, ROWS, 1, 12).select(
        n.alias("item_id"),
        F.when(n % 3 == 0, 3).otherwise(n).cast("long").alias("order_id"),
        F.when(n % 3 == 0, 3).otherwise(n % 200).cast("int").alias("menu_id"),
        F.lit(1).alias("quantity"),
        F.lit(10).cast("decimal(12,2)").alias("price_per_item"),
        F.lit(10).cast("decimal(14,2)").alias("subtotal"),
        F.lit("2026").alias("year"),
        F.lit("03").alias("month"),
        F.lit("01").alias("day"),
    )
    items.write.parquet(str(tmp_path / "items"))
    return spark.read.parquet(str(tmp_path / "items"))


def test_fact_join_splits_a_hot_order(spark, hot_items, tiny_partitions):
    from tillhouse.plans.gold import fact_order_items

    orders = spark.range(0, ROWS, 1, 6).selectExpr(
        "id AS order_id", "1 AS outlet_id", "1 AS cashier_id", "CAST(10 AS DECIMAL(14,2)) AS total_amount",
        "'Cash' AS payment_method", "TIMESTAMP '2026-03-01 10:00:00' AS created_at", "'valid' AS data_quality_status",
    )
    fact = fact_order_items(orders, hot_items)
    assert splits_skew(fact)
    assert fact.count() == ROWS


def test_menu_joins_split_a_hot_menu(spark, hot_items, tiny_partitions):
    menu = spark.range(0, 190).selectExpr(
        "CAST(id AS INT) AS menu_id", *[f"CAST(11 AS DECIMAL(12,2)) AS {name}" for name in quality.MENU_PRICES]
    )
    priced = quality.with_menu_prices(hot_items, menu)
    assert splits_skew(priced)
    assert priced.count() == ROWS
    orphans = quality.orphans(hot_items, menu.filter("menu_id <> 3"), "menu_id")
    assert splits_skew(orphans)
    assert orphans.filter("menu_id = 3").count() >= ROWS // 3


def test_item_extract_splits_a_hot_order(spark, hot_items, tiny_partitions):
    from datetime import date

    from tillhouse.sources.source import items_between

    orders = spark.range(0, ROWS, 1, 6).selectExpr("id AS order_id", "TIMESTAMP '2026-03-01 10:00:00' AS created_at")
    rows = items_between(hot_items.drop("year", "month", "day"), orders, date(2026, 3, 1), date(2026, 3, 1))
    assert splits_skew(rows)
    assert rows.count() == ROWS


def test_counts_do_not_shuffle_hot_rows(spark, hot_items, tiny_partitions):
    """Foreign keys are counted per value first: at most one row per value and map task is shuffled."""
    from tillhouse.operators.checks import unmatched

    missing = unmatched(hot_items, "menu_id", spark.range(0, 100).selectExpr("CAST(id AS INT) AS menu_id"), "menu_id")
    assert missing.agg(F.sum("n_records")).first()[0] == hot_items.filter("menu_id >= 100").count()
    assert not splits_skew(missing)
