"""Joins that spread the rows of a hot key over many tasks.

Adaptive execution splits a skewed partition only when a join reads both sides straight
from a shuffle. It cannot when one side is aggregated on the join key first. This join
does not depend on the shape of the plan: it counts the rows per key, and gives every key
above a row limit as many salts as it fills splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys with more rows than one split holds, and the splits they need.

    At most one key in rows_per_split rows can be hot, so the frame stays small enough
    to broadcast: a million keys for 10^12 rows.
    """
    return hot_of(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), keys, "_rows", rows_per_split)


def hot_of(counts: DataFrame, keys: list[str], rows: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """The same from rows that have been counted per key before; keys that are not hot may be missing."""
    return counts.filter(F.col(rows) > rows_per_split).select(
        *[F.col(key).alias(f"_hot_{key}") for key in keys],
        F.ceil(F.col(rows) / rows_per_split).cast("int").alias("_splits"),
    )


def split_hot_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    rows_per_split: int = ROWS_PER_SPLIT,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join (inner or left) whose left side may hold any share of its rows on one key.

    Rows of a hot key are salted on the left; the matching right rows are repeated once
    per salt. All other rows have salt 0 and are joined as usual. hot are the left side's hot keys where they
    are known; else its rows are counted here. Known ones are a stored table, so Spark goes by its size.
    """
    hot = F.broadcast(hot_keys(left, keys, rows_per_split)) if hot is None else hot
    salted_left = left.join(hot, _same_key(left, hot, keys), "left").select(
        *[left[name] for name in left.columns], _row_salt(left).alias("_salt")
    )
    salted_right = right.join(hot, _same_key(right, hot, keys), "left").select(
        *[right[name] for name in right.columns],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1)).alias("_salt"),
    )
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def _same_key(df: DataFrame, hot: DataFrame, keys: list[str]) -> Column:
    """NULL is a key too: a large group of rows without key has to be spread as well."""
    return reduce(lambda a, b: a & b, [df[key].eqNullSafe(hot[f"_hot_{key}"]) for key in keys])


def _row_salt(df: DataFrame) -> Column:
    """From the values and the input partition: exact copies of a row are spread as well,
    and a task that runs again gives its rows the same salts."""
    spread = F.hash(F.spark_partition_id(), *[df[name] for name in df.columns])
    return F.when(F.col("_splits").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("_splits")))
