"""Days whose source rows are no longer those that silver holds, however late they changed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.functions.dates import day_keys
from tillhouse.layout import Layout
from tillhouse.schemas import ORDER_ITEMS, ORDERS, TRANSACTIONS
from tillhouse.sources import commits, tables


def typed(rows: DataFrame, schema: StructType) -> DataFrame:
    """Source rows as silver has them, with the day they belong to."""
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    return rows.select(*columns, *day_keys(F.col("created_at")))


def source_prints(source, first: date, last: date) -> dict[str, dict[date, dict]]:
    """Number and hash of the source's rows, by table and day; one row per day reaches the driver."""
    orders = typed(source.orders(first, last), ORDERS)
    items = typed(source.items(first, last), ORDER_ITEMS)
    return {"orders": tables.day_hashes(orders), "order_items": tables.day_hashes(items)}


def stored_prints(spark: SparkSession, layout: Layout) -> dict[str, dict[date, dict]]:
    """The same of what silver holds, as it was noted with each day."""
    return {
        name: {
            day: entry.notes for day, entry in commits.state(spark, f"{layout.silver}/{name}").days.items() if entry.notes
        }
        for name in TRANSACTIONS
    }


def compare(now: dict[str, dict[date, dict]], held: dict[str, dict[date, dict]]) -> list[tuple]:
    """(day, orders and items held, orders and items now) of each day that differs."""
    none = {"rows": 0, "hash": "0"}
    found = []
    for day in sorted({day for part in (now, held) for prints in part.values() for day in prints}):
        before, after = ([part[name].get(day, none) for name in TRANSACTIONS] for part in (held, now))
        if before != after:
            found.append((day, *[each["rows"] for each in (*before, *after)]))
    return found


def changed_days(spark: SparkSession, source, layout: Layout, first: date, last: date) -> DataFrame:
    """Days from first to last on which silver does not hold the source's rows: new, changed and emptied ones.

    A day counts as changed if any value of any of its rows differs, if rows came late or went, for orders and items
    alike. Values that a raw file cannot hold as they are make their day come up each time.
    """
    held = {
        name: {day: print_ for day, print_ in prints.items() if first <= day <= last}
        for name, prints in stored_prints(spark, layout).items()
    }
    rows = compare(source_prints(source, first, last), held)
    names = ("orders_before", "items_before", "orders_now", "items_now")
    return spark.createDataFrame(rows, ", ".join(["day date", *[f"{name} long" for name in names]]))


def late_days(spark: SparkSession, source, layout: Layout, last: date) -> list[date]:
    """Days to run again: what has changed since the first stored day, up to the given one."""
    stored = tables.every_stored_day(spark, f"{layout.silver}/orders")
    if not stored:
        return []
    return [row.day for row in changed_days(spark, source, layout, min(stored), last).collect()]
