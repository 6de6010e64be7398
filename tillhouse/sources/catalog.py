"""Catalog tables over the silver and gold files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tillhouse.layout import DAY_KEYS, Layout, partition_text
from tillhouse.schemas import FACT, MENU_MASTER, ORDER_ITEMS, OUTLET_MASTER, SILVER_ORDERS
from tillhouse.sources import commits

SILVER_TABLES = {
    "outlet_master": (OUTLET_MASTER, False),
    "menu_master": (MENU_MASTER, False),
    "orders": (SILVER_ORDERS, True),
    "order_items": (ORDER_ITEMS, True),
}


def create_external_table(
    spark: SparkSession, name: str, schema: StructType, location: str, by_day: bool
) -> None:
    """Fixed columns, text partition keys, files stay where they are."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
    keys = ", ".join(f"{key} string" for key in DAY_KEYS)
    if by_day:
        columns = f"{columns}, {keys}"
    partitioned = f"PARTITIONED BY ({', '.join(DAY_KEYS)})" if by_day else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} LOCATION '{location}'"
    )


def register_days(spark: SparkSession, name: str, location: str, days: list[date] | None = None) -> None:
    """Point the table's partitions at the runs that the newest commit names, for the given days or all.

    New days are added by one statement and changed ones moved to their new folder, so a day is never away in between;
    days that have become empty are dropped. Nothing is listed but the table's partitions in the catalog.
    """
    held = commits.state(spark, location)
    named = sorted(held.days if days is None else set(days))
    known = {row.partition for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    filled = held.filled(named)
    new = [day for day in filled if partition_text(day) not in known]
    if new:
        places = [f"{_spec(day)} LOCATION '{commits.run_folder(location, day, held.days[day].run)}'" for day in new]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")
    for day in sorted(set(filled) - set(new)):
        folder = commits.run_folder(location, day, held.days[day].run)
        spark.sql(f"ALTER TABLE {name} {_spec(day)} SET LOCATION '{folder}'")
    gone = [_spec(day) for day in named if day not in filled and partition_text(day) in known]
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone)}")
    spark.catalog.refreshTable(name)


def _spec(day: date) -> str:
    return f"PARTITION (year='{day.year}', month='{day.month:02d}', day='{day.day:02d}')"


def create_database(spark: SparkSession, layout: Layout, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{layout.gold}/_database'")


def create_gold_tables(spark: SparkSession, layout: Layout, database: str, days: list[date] | None = None) -> None:
    """Tables over the star schema; the dimensions take their columns from the files."""
    for table in ("dim_date", "dim_menu", "dim_outlet"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} USING parquet LOCATION '{layout.gold}/{table}'")
        spark.catalog.refreshTable(f"{database}.{table}")
    fact = f"{database}.fact_order_items"
    create_external_table(spark, fact, FACT, f"{layout.gold}/fact_order_items", by_day=True)
    register_days(spark, fact, f"{layout.gold}/fact_order_items", days)


def create_silver_tables(spark: SparkSession, layout: Layout, database: str, days: list[date] | None = None) -> None:
    for table, (schema, by_day) in SILVER_TABLES.items():
        create_external_table(spark, f"{database}.{table}", schema, f"{layout.silver}/{table}", by_day)
        if by_day:
            register_days(spark, f"{database}.{table}", f"{layout.silver}/{table}", days)


def publish(spark: SparkSession, layout: Layout, database: str, days: list[date]) -> None:
    """The step after a run's commits: its tables are there, and their partitions of its days are those of the run."""
    create_database(spark, layout, database)
    create_silver_tables(spark, layout, database, days)
    create_gold_tables(spark, layout, database, days)
