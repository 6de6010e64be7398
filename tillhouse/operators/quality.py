"""Data-quality rules. Every rule returns the offending rows as a DataFrame.

scope lists the columns one batch is told apart by: nothing for a single batch, the day
keys when many days are checked in one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.fixed_values import OUTLIER_DEVIATIONS
from tillhouse.functions.labels import order_status, payment_invalid, price_valid, total_differs
from tillhouse.operators.skew import ROWS_PER_SPLIT, hot_of, split_hot_join
from tillhouse.schemas import AMOUNT_SUM

MENU_PRICES = ["base_price", "price_tier_1", "price_tier_2", "price_tier_3"]


def order_totals(items: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return items.groupBy(*scope, "order_id").agg(
        F.sum("subtotal").cast(AMOUNT_SUM).alias("calculated_total")
    )


def with_order_totals(
    orders: DataFrame,
    items: DataFrame,
    scope: Sequence[str] = (),
    rows_per_split: int = ROWS_PER_SPLIT,
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """Orders with the sum of their items; NULL for an order without items.

    duplicates are the orders' repeated ids with their counts, where they have been found before: hot ids are among them.
    """
    columns, keys = orders.columns, [*scope, "order_id"]
    hot = None if duplicates is None else hot_of(duplicates, keys, "count", rows_per_split)
    joined = split_hot_join(orders, order_totals(items, scope), keys, "left", rows_per_split, hot)
    return joined.select(*columns, "calculated_total")


def with_status(orders_with_totals: DataFrame) -> DataFrame:
    return orders_with_totals.withColumn(
        "data_quality_status", order_status(F.col("total_amount"), F.col("calculated_total"))
    )


def orders_without_items(orders_with_totals: DataFrame) -> DataFrame:
    return orders_with_totals.filter(F.col("calculated_total").isNull())


def order_discrepancies(orders_with_totals: DataFrame) -> DataFrame:
    """Total differs from the item sum; orders without items are not in it."""
    return orders_with_totals.filter(total_differs(F.col("total_amount"), F.col("calculated_total")))


def orphans(df: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Rows whose key the master does not know."""
    return df.join(master.select(key), key, "left_anti").select(*df.columns)


def invalid_payments(orders: DataFrame) -> DataFrame:
    return orders.filter(payment_invalid(F.col("payment_method")))


def with_menu_prices(items: DataFrame, menu: DataFrame) -> DataFrame:
    return _priced(items, menu).drop("menu_known")


def _priced(items: DataFrame, menu: DataFrame) -> DataFrame:
    prices = [F.col(name) for name in MENU_PRICES]
    known = menu.select("menu_id", *MENU_PRICES, F.lit(True).alias("menu_known"))
    return items.join(known, "menu_id", "left").select(
        *items.columns,
        *MENU_PRICES,
        price_valid(F.col("price_per_item"), *prices).alias("price_valid"),
        "menu_known",
    )


def bad_items(items: DataFrame, menu: DataFrame) -> DataFrame:
    """Items that break a menu rule, both rules from one join: unknown menu or a price that is none of its prices."""
    return _priced(items, menu).filter(F.col("menu_known").isNull() | ~F.col("price_valid"))


def unknown_menu(bad: DataFrame) -> DataFrame:
    return bad.filter(F.col("menu_known").isNull()).drop(*MENU_PRICES, "price_valid", "menu_known")


def off_price(bad: DataFrame) -> DataFrame:
    """Items with an unknown menu are not in it."""
    return bad.filter(~F.col("price_valid")).drop("menu_known")


def invalid_prices(items: DataFrame, menu: DataFrame) -> DataFrame:
    return off_price(bad_items(items, menu))


def duplicate_orders(orders: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return (
        orders.groupBy(*scope, "order_id").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
    )


def cashier_counts(
    orders: DataFrame, scope: Sequence[str] = (), group_cols: Sequence[str] = ("cashier_id",)
) -> DataFrame:
    return orders.groupBy(*scope, *group_cols).agg(F.count("order_id").alias("tx_count"))


def cashier_stats(counts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation (0 when undefined) and the limit above which a count is an outlier.

    The limit is NULL, hence never exceeded, when the counts do not vary.
    """
    deviation = F.coalesce(F.stddev("tx_count"), F.lit(0.0))
    stats = counts.groupBy(*scope).agg(F.avg("tx_count").alias("mean_tx"), deviation.alias("stddev_tx"))
    limit = F.col("mean_tx") + OUTLIER_DEVIATIONS * F.col("stddev_tx")
    return stats.withColumn("threshold", F.when(F.col("stddev_tx") > 0, limit))


def cashier_outliers(
    orders: DataFrame, scope: Sequence[str] = (), group_cols: Sequence[str] = ("cashier_id",)
) -> DataFrame:
    counts = cashier_counts(orders, scope, group_cols)
    stats = cashier_stats(counts, scope)
    if not scope:
        return counts.filter(F.col("tx_count") > stats.select("threshold").scalar())
    limits = stats.select(*scope, "threshold")
    return (
        counts.join(limits, list(scope)).filter(F.col("tx_count") > F.col("threshold")).select(*counts.columns)
    )


def count_moments(counts: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Number, mean and sum of squared deviations of the counts of each batch: all that later windows need of it."""
    values = F.col("tx_count").cast("double")
    return counts.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(values).alias("mean"),
        (F.coalesce(F.var_samp(values), F.lit(0.0)) * (F.count(F.lit(1)) - 1)).alias("m2"),
    )


def merged_moments(moments: DataFrame, group: Sequence[str]) -> DataFrame:
    """The moments of batches together, as if their counts had been taken as one batch; the counts are not needed."""
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    # deviations from the common mean: those within batches, and those of their means
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - total * mean * mean
    return moments.groupBy(*group).agg(total.alias("n"), mean.alias("mean"), (F.sum("m2") + between).alias("m2"))


def outliers_in_window(counts: DataFrame, moments: DataFrame, days: int) -> DataFrame:
    """Counts of a day that are outliers among all counts of the window of days that ends with it.

    counts: date, cashier_id, tx_count; moments: date, n, mean, m2, one row per day. With several days
    in a window a few cashiers are enough for a rule that a single day can never break.
    """
    spread = moments.withColumn("date", F.explode(F.sequence("date", F.date_add("date", days - 1))))
    merged = merged_moments(spread, ["date"])
    deviation = F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1))
    limits = merged.filter("n > 1").select("date", "mean", deviation.alias("deviation"))
    found = counts.join(limits.filter("deviation > 0"), "date")
    return found.filter(F.col("tx_count") > F.col("mean") + OUTLIER_DEVIATIONS * F.col("deviation")).select(*counts.columns)


def rule_counts(
    orders_with_totals: DataFrame,
    bad: DataFrame,
    found: Mapping[str, DataFrame],
    scope: Sequence[str] = (),
    batches: DataFrame | None = None,
) -> DataFrame:
    """Violations per rule and batch, as rows (scope..., rule, violations).

    The rules on a single order share one pass, so do the rules on a single item; found
    holds the rows other rules have found. Every batch lists every rule, also those that
    found nothing; batches holds the scope columns of all batches, needed where there is a scope.
    """
    totals, calculated = F.col("total_amount"), F.col("calculated_total")
    order_rules = orders_with_totals.groupBy(*scope).agg(
        F.count_if(calculated.isNull()).alias("orders_without_items"),
        F.count_if(total_differs(totals, calculated)).alias("orders_discrepancies"),
        F.count_if(payment_invalid(F.col("payment_method"))).alias("invalid_payments"),
        F.count_if(F.col("payment_method").isNull()).alias("null_payments"),
    )
    item_rules = bad.groupBy(*scope).agg(
        F.count_if(F.col("menu_known").isNull()).alias("orphan_items"),
        F.count_if(~F.col("price_valid")).alias("invalid_prices"),
    )
    others = [
        rows.groupBy(*scope).agg(F.count(F.lit(1)).alias(rule)) for rule, rows in found.items()
    ]
    combined = reduce(DataFrame.unionByName, [_as_rules(df, scope) for df in (order_rules, item_rules, *others)])
    if not scope:
        return combined
    counted = (order_rules, item_rules, *others)
    rules = [name for df in counted for name in df.columns if name not in scope]
    grid = batches.select(*scope, F.explode(F.array(*map(F.lit, rules))).alias("rule"))
    violations = F.coalesce("violations", F.lit(0)).alias("violations")
    return grid.join(combined, [*scope, "rule"], "left").select(*scope, "rule", violations)


def _as_rules(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    rules = [name for name in df.columns if name not in scope]
    return df.unpivot(list(scope), rules, "rule", "violations")


def sample_rows(df: DataFrame, columns: list[str], rows: int = 5) -> DataFrame:
    """A few offending rows to look at, the same ones each time."""
    return df.select(*columns).orderBy(*columns).limit(rows)
