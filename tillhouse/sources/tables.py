"""Parquet tables: whole-table and per-day overwrite, per-day reads, keyed inserts."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.functions.dates import in_days
from tillhouse.layout import DAY_KEYS, RUN_KEY
from tillhouse.schemas import with_days
from tillhouse.session import file_system
from tillhouse.sources import commits

log = logging.getLogger(__name__)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# A task's files go straight to their folder when it ends. They do not count before the commit names them.
COMMITTER = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
# On a local disk every file and folder costs a process that sets its permissions; files with checksums cost three.
LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_days(
    df: DataFrame,
    path: str,
    days: list[date],
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    aligned: bool = False,
    notes: Callable[[str, list[date]], dict[date, dict]] | None = None,
    chosen: bool = False,
) -> None:
    """Replace the given days of a table, in one job and one commit.

    Rebalancing puts a small day into one file and splits a large one over several tasks.
    aligned says that df comes straight from files that are already split by day: then
    nothing is shuffled. A day that produced no rows is recorded as empty. Rows of other
    days are left out: days outside the list are not touched; chosen says that df has no such
    rows, so that they need not be looked for. notes gives what is kept with each day of the
    run, before it counts.
    """
    spark = df.sparkSession
    run = commits.new_run()
    if not chosen:
        df = df.filter(in_days(days))
    if not aligned:
        df = df.hint("rebalance", *DAY_KEYS)
    (
        df.withColumn(RUN_KEY, F.lit(run))
        .write.mode("append")
        .options(**COMMITTER, **LOCAL, **(options or {}))
        .partitionBy(RUN_KEY, *DAY_KEYS)
        .format(fmt)
        .save(path)
    )
    found = commits.written_days(spark, path, days, run)
    noted = notes(run, found) if notes else {}
    new = {day: commits.Entry(run, day not in found, noted.get(day, {})) for day in days}
    commits.commit(spark, path, lambda held: held | new)


def day_hashes(rows: DataFrame) -> dict[date, dict]:
    """Row count and hash of each day; the hash does not depend on the rows' order. One row per day is collected."""
    columns = [name for name in rows.columns if name not in DAY_KEYS]
    # both halves of a hash are summed as whole numbers of 64 bits; a decimal for each row costs several times that
    hashed = rows.select(*DAY_KEYS, F.xxhash64(*columns).alias("_hash"))
    found = hashed.groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.shiftright("_hash", 32)).alias("high"),
        F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )
    return {
        date(int(row.year), int(row.month), int(row.day)): {"rows": row.rows, "hash": str((row.high << 32) + row.low)}
        for row in found.collect()
    }


def written_hashes(spark: SparkSession, path: str, schema: StructType) -> Callable[[str, list[date]], dict[date, dict]]:
    """Notes for write_days: count and hash of the rows it has just written, read back from their files."""

    def notes(run: str, found: list[date]) -> dict[date, dict]:
        folders = [commits.run_folder(path, day, run) for day in found]
        return day_hashes(read_folders(spark, path, schema, folders)) if folders else {}

    return notes


def stored_days(spark: SparkSession, path: str, days: list[date]) -> list[date]:
    """Those of the days that have rows."""
    return commits.state(spark, path).filled(days)


def every_stored_day(spark: SparkSession, path: str) -> list[date]:
    """All days that have rows."""
    return commits.state(spark, path).filled()


def clear_days(spark: SparkSession, path: str, days: list[date], notes: dict[date, dict] | None = None) -> None:
    """Record the days as empty."""
    run = commits.new_run()
    new = {day: commits.Entry(run, True, (notes or {}).get(day, {})) for day in days}
    if new:
        commits.commit(spark, path, lambda held: held | new)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_day_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    days: list[date] | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    held: commits.State | None = None,
) -> DataFrame:
    """Read only the folders of the given days, or of all: nothing else of the table is even listed.

    held is the state to read, if not the newest.
    """
    held = held or commits.state(spark, path)
    folders = held.folders(path, days)
    if days is not None and len(folders) < len(set(days)):
        log.warning("%s: no rows for %d of %d days", path, len(set(days)) - len(folders), len(set(days)))
    return read_folders(spark, path, schema, folders, fmt, options)


def read_folders(
    spark: SparkSession,
    path: str,
    schema: StructType,
    folders: list[str],
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    full = with_days(schema)
    if not folders:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).options(**(options or {})).option("basePath", path)
    return reader.format(fmt).load(folders).select(*full.fieldNames())


def read_partitioned(spark: SparkSession, path: str, schema: StructType, days: list[date] | None = None) -> DataFrame:
    """The whole table as it is now, pruned by the partition keys when days are given."""
    table = read_day_files(spark, path, schema)
    return table.filter(in_days(days)) if days else table


def new_rows(arriving: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Arriving rows whose key is not stored yet, one row per key: the smallest if they differ."""
    columns = arriving.columns
    unique = arriving.groupBy(key).agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return unique.join(existing.select(key), key, "left_anti").select(*columns)


# Folder of the rows whose keys have one remainder; the number of buckets is part of its name, so a table tells it itself.
BUCKET = "bucket"
BUCKETS = 64


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.format_string(f"%d-of-{buckets}", F.pmod(F.xxhash64(key), F.lit(buckets))))


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """A table whose rows lie in folders by the hash of their key."""
    _bucketed(df, key, buckets).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def _stored_buckets(spark: SparkSession, path: str) -> list[str]:
    fs, pattern = file_system(spark, f"{path}/{BUCKET}=*")
    return sorted(entry.getPath().getName().removeprefix(f"{BUCKET}=") for entry in fs.globStatus(pattern) or [])


def read_keyed(spark: SparkSession, path: str, schema: StructType, chosen: list[str] | None = None) -> DataFrame:
    """The rows of a keyed table, or of some of its buckets: other folders are not even listed."""
    stored = _stored_buckets(spark, path)
    folders = [f"{path}/{BUCKET}={name}" for name in stored if chosen is None or name in chosen]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def insert_if_absent(arriving: DataFrame, path: str, key: str) -> None:
    """Append rows with new keys; running it again adds nothing.

    Of a keyed table only the buckets that the arriving keys fall into are read: which these are is one row per bucket.
    """
    spark = arriving.sparkSession
    stored = _stored_buckets(spark, path)
    if not stored:
        existing = spark.read.schema(arriving.schema).parquet(path)
        new_rows(arriving, existing, key).write.mode("append").parquet(path)
        return
    buckets = int(stored[0].rsplit("-", 1)[1])
    rows = _bucketed(arriving, key, buckets)
    chosen = [row[0] for row in rows.select(BUCKET).distinct().collect()]
    existing = read_keyed(spark, path, arriving.schema, chosen)
    new = _bucketed(new_rows(arriving, existing, key), key, buckets)
    new.write.mode("append").partitionBy(BUCKET).parquet(path)


def max_id(df: DataFrame, key: str) -> DataFrame:
    """Largest key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("max_id"))
