"""Declarative data tests. A test returns the rows that violate it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.fixed_values import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS
from tillhouse.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; a missing value is no duplicate."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value the parent does not have; missing values are not looked up."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)


def unmatched(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The same counted per value: both sides are reduced to one row per value before the join."""
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return counted.join(known, column, "left_anti")


def freshness(df: DataFrame, loaded_at: str, as_of: str, table: str) -> DataFrame:
    """Age in hours of the newest row, against the warning and the error limit."""
    newest = df.agg(F.max(loaded_at).cast("timestamp").alias("newest"))
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("newest")
    age = F.floor(seconds / 3600)
    status = (
        F.when(seconds > FRESHNESS_ERROR_HOURS * 3600, "error")
        .when(seconds > FRESHNESS_WARN_HOURS * 3600, "warn")
        .when(seconds.isNotNull(), "pass")
        .otherwise("error")
    )
    return newest.select(
        F.lit(table).alias("table_name"),
        F.to_date("newest").alias("newest_day"),
        age.cast("long").alias("age_hours"),
        status.alias("status"),
    )


def column_counts(extracts: Mapping[str, DataFrame]) -> DataFrame:
    """Per extract the number of columns wanted and found, and the rows that have them."""
    return _union(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(NOT_NULL[name])).alias("expected_columns"),
            F.lit(len(df.columns)).alias("found_columns"),
            "row_count",
        )
        for name, df in extracts.items()
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


@dataclass(frozen=True)
class Check:
    """A declared test of one column: no NULL, no value twice, or every value known to a parent table's column.

    where restricts it to some rows; for relationships, to some child rows.
    """

    kind: str
    table: str
    column: str
    parent: str = ""
    parent_column: str = ""
    where: Column | None = None


def violations(tables: Mapping[str, DataFrame], tests: Mapping[str, Check]) -> DataFrame:
    """test_name, violations of all tests, from one scan of each table.

    A row is turned into what its table's tests want to know of it: a value with what it counts for, as child or as parent, or
    a mere count where it is NULL. One aggregation over tests and values then answers all tests: values seen twice, child
    rows of values that no parent has. Values are counted before they are shuffled, so a frequent one costs a row per task.
    """
    numbered = list(tests.items())
    entries = []
    for name, df in tables.items():
        found = [entry for i, (_, test) in enumerate(numbered) for entry in _entries(df, name, i, test)]
        if found:
            entries.append(df.select(F.explode(F.array_compact(F.array(*found))).alias("entry")).select("entry.*"))
    counted = _union(entries).groupBy("test", "number", "text").agg(F.sum("n").alias("n"), F.sum("known").alias("known"))

    def of(kind: str) -> Column:
        return F.col("test").isin([i for i, (_, test) in enumerate(numbered) if test.kind == kind])

    broken = (
        F.when(of("not_null"), F.col("n"))
        .when(of("unique"), (F.col("n") > 1).cast("long"))
        .otherwise(F.when(F.col("known") == 0, F.col("n")).otherwise(0))
    )
    found = counted.groupBy("test").agg(F.sum(broken).alias("violations"))
    names = [F.struct(F.lit(i).alias("test"), F.lit(name).alias("test_name")) for i, (name, _) in enumerate(numbered)]
    listed = found.sparkSession.range(1).select(F.inline(F.array(*names)))
    return listed.join(found, "test", "left").select("test_name", F.coalesce("violations", F.lit(0)).alias("violations"))


def _entries(df: DataFrame, name: str, i: int, test: Check) -> list[Column]:
    """What the rows of a table contribute to a test: structs (test, number, text, n, known), NULL for no contribution."""

    def entry(column: str, wanted: Column, n: int, known: int, valued: bool = True) -> Column:
        whole = df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")
        number = F.col(column).cast("long") if whole and valued else F.lit(None).cast("long")
        text = F.col(column).cast("string") if valued and not whole else F.lit(None).cast("string")
        parts = {"test": F.lit(i), "number": number, "text": text, "n": F.lit(n).cast("long"), "known": F.lit(known).cast("long")}
        return F.when(wanted, F.struct(*[value.alias(part) for part, value in parts.items()]))

    scope = F.lit(True) if test.where is None else F.coalesce(test.where, F.lit(False))
    found = []
    if name == test.table:
        missing = F.col(test.column).isNull()
        if test.kind == "not_null":
            found.append(entry(test.column, scope & missing, 1, 0, valued=False))
        else:
            found.append(entry(test.column, scope & ~missing, 1, 0))
    if test.kind == "relationships" and name == test.parent:
        found.append(entry(test.parent_column, F.col(test.parent_column).isNotNull(), 0, 1))
    return found


def constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of the source's NOT NULL, primary-key and foreign-key declarations."""
    declared = [Check("not_null", name, column) for name in tables for column in NOT_NULL[name]]
    declared += [Check("unique", name, PRIMARY_KEYS[name]) for name in tables]
    declared += [Check("relationships", *key) for key in FOREIGN_KEYS]
    kinds = {"relationships": "foreign_key"}
    names = [f"{kinds.get(test.kind, test.kind)} {test.table} {test.column}" for test in declared]
    found = violations(tables, dict(zip(names, declared, strict=True)))
    parts = F.split("test_name", " ")
    columns = ["constraint_kind", "table_name", "column_name"]
    return found.select(*[parts[k].alias(column) for k, column in enumerate(columns)], "violations")


def summary_of(tables: Mapping[str, DataFrame], tests: Mapping[str, Check]) -> DataFrame:
    """One row per test: its violations and whether it passed."""
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status")
    return violations(tables, tests).select("test_name", "violations", status)


def result(name: str, violating: DataFrame) -> DataFrame:
    """One row for a test: its violations and whether it passed."""
    return violating.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("test_name"),
        "violations",
        F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status"),
    )


def summary(tests: Mapping[str, DataFrame]) -> DataFrame:
    return _union(result(name, violating) for name, violating in tests.items())


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
