"""Date and partition-key expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.fixed_values import RECENT_DAYS, WEEKEND_LABELS
from tillhouse.layout import DAY_KEYS


def padded(number: Column, width: int = 2) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def day_keys(moment: Column) -> list[Column]:
    """Partition keys as text: four-digit year, two-digit month and day."""
    return [
        F.year(moment).cast("string").alias("year"),
        padded(F.month(moment)).alias("month"),
        padded(F.dayofmonth(moment)).alias("day"),
    ]


def plain_day_keys(moment: Column) -> list[Column]:
    """The same keys without padding, as the master history stores them."""
    return [
        F.year(moment).cast("string").alias("year"),
        F.month(moment).cast("string").alias("month"),
        F.dayofmonth(moment).cast("string").alias("day"),
    ]


def with_day_keys(df: DataFrame, moment: str) -> DataFrame:
    return df.select("*", *day_keys(F.col(moment)))


def day_text() -> Column:
    """Partition keys joined to YYYY-MM-DD, which sorts like the date."""
    return F.concat_ws("-", *DAY_KEYS)


def in_days(days: list[date]) -> Column:
    """Predicate on the partition keys that holds on these days only; prunes partitions."""
    return day_text().isin([day.isoformat() for day in days])


def on_day(day: date) -> Column:
    """Equality on each text key."""
    return (
        (F.col("year") == f"{day.year}")
        & (F.col("month") == f"{day.month:02d}")
        & (F.col("day") == f"{day.day:02d}")
    )


def within(moment: Column, start: date, end: date) -> Column:
    """Half-open range over whole days, so that the source can use it as a plain range."""
    after = end + timedelta(days=1)
    return (moment >= F.lit(start.isoformat()).cast("timestamp")) & (
        moment < F.lit(after.isoformat()).cast("timestamp")
    )


def recent(as_of: date, days: int = RECENT_DAYS) -> Column:
    """Rows whose partition is not older than the given number of days."""
    return day_text() >= F.date_sub(F.lit(as_of.isoformat()).cast("date"), days).cast("string")


def iso_weekday(day: Column) -> Column:
    """Monday is 1."""
    return F.weekday(day) + 1


def weekend_label(day: Column) -> Column:
    weekend, weekday = WEEKEND_LABELS
    return F.when(iso_weekday(day).isin(6, 7), weekend).otherwise(weekday)


def year_month(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-"), padded(F.month(day)))
