"""Raw layer: CSV files with a header, flat for masters, one folder per day for transactions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillhouse.functions.dates import day_keys
from tillhouse.functions.fixed_values import NULL_TEXT
from tillhouse.layout import DAY_KEYS, stretches
from tillhouse.schemas import MALFORMED_LINE
from tillhouse.sources.commits import State
from tillhouse.sources.source import as_text
from tillhouse.sources.tables import read_day_files, write_days

# Masters are small, so a line break in a value may cost their files' splitting. In transactions it is written as
# two characters, and so is the backslash that marks it.
MASTER_OPTIONS = {"multiLine": "true"}
# So is a value that reads like the NULL text.
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"), (NULL_TEXT, "\\0"))

# Quotes inside a value are doubled, NULL is written out as text, blanks at both ends of a value stay.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": NULL_TEXT,
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Column that holds a raw line as it is when a value does not fit its type or the number of values is wrong.
RESCUED = MALFORMED_LINE.name


def write_master(df: DataFrame, path: str) -> None:
    as_text(df).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_transactions(df: DataFrame, columns: list[str], path: str, days: list[date]) -> None:
    """Split by the day of created_at, which items carry from their order.

    Rows are shuffled as they come, with their day as one date; they become text where they are written.
    """
    on = F.col("_day")
    wanted = reduce(Column.__or__, [on.between(F.lit(first), F.lit(last)) for first, last in stretches(days)], F.lit(False))
    dated = df.select(*columns, F.to_date("created_at").alias("_day")).filter(wanted).hint("rebalance", "_day")
    keyed = _replaced(dated, ESCAPES).select(*columns, *day_keys(on))
    write_days(as_text(keyed), path, days, fmt="csv", options=CSV_OPTIONS, aligned=True, chosen=True)


def read_master(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS, **MASTER_OPTIONS).csv(path)


def read_transactions(
    spark: SparkSession,
    path: str,
    schema: StructType,
    days: list[date],
    held: State | None = None,
    rescue: bool = False,
) -> DataFrame:
    """Rows of the given days; days without files are skipped with a warning.

    Values that cannot be read are NULL. With rescue the line they come from is kept, in one more column that is NULL
    for all other rows.
    """
    options = CSV_OPTIONS
    if rescue:
        schema = StructType([*schema.fields, MALFORMED_LINE])
        options = options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}
    rows = read_day_files(spark, path, schema, days, fmt="csv", options=options, held=held)
    return _replaced(rows, [(code, text) for text, code in reversed(ESCAPES)])


def _replaced(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """All text columns but the day keys, with each pair replaced in order."""

    def column(field: StructField) -> Column:
        if field.dataType.typeName() != "string" or field.name in (*DAY_KEYS, RESCUED):
            return F.col(field.name)
        return reduce(lambda text, pair: F.replace(text, *map(F.lit, pair)), pairs, F.col(field.name)).alias(field.name)

    return df.select(*[column(field) for field in df.schema])


def preview(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """First rows as plain text columns, header line included, in a stable order."""
    lines = spark.read.csv(path)
    return lines.orderBy(*lines.columns).limit(rows)


def malformed(spark: SparkSession, path: str, schema: StructType, days: list[date]) -> DataFrame:
    """Raw lines of the days that do not fit the schema."""
    return malformed_lines(read_transactions(spark, path, schema, days, rescue=True))


def malformed_lines(rows: DataFrame) -> DataFrame:
    """Lines that did not fit, of rows read with rescue."""
    # only values that are asked for are parsed, so every column is looked at
    others = [F.col(name).cast("string") for name in rows.columns if name not in (*DAY_KEYS, RESCUED)]
    every_value_read = F.length(F.concat_ws("", *others)) >= 0
    return rows.filter(F.col(RESCUED).isNotNull() & every_value_read).select(RESCUED, *DAY_KEYS)
