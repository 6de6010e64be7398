"""Raw days as a stream: take in what has been committed since the last run, then stop."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillhouse.sources import commits, tables
from tillhouse.sources.bronze import read_transactions

#: What the ledger has of an emptied day.
NOTHING = {"rows": 0, "hash": "0"}


def ingest_arrivals(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, days_per_batch: int = 10_000
) -> None:
    """Land raw days as typed Parquet whenever their raw files have been committed anew.

    The stream consists of the raw layer's commits, so the checkpoint holds a name for each commit and none of data files.
    What has been taken in is told by the ledger: each landed day carries the raw run it was read from, its row count
    and the hash of its rows, and becomes visible together with them, in one commit of the target. A batch lands the
    days whose raw run is not the one in the ledger; repeating it, or losing the checkpoint, lands nothing twice.

    A day is emptied only by a raw commit that says it is empty. Days that are not in the raw layer's commit, or a raw layer
    that is not there, take nothing away. Raw files are split by day already, so landing them needs no shuffle.
    """
    if not commits.versions(spark, source):
        return

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        raw = commits.state(session, source)
        due = due_days(raw, commits.state(session, target))
        for at in range(0, len(due), days_per_batch):
            land_days(session, source, raw, schema, target, due[at : at + days_per_batch])

    arrivals = spark.readStream.option("pathGlobFilter", "*.json").text(f"{source}/{commits.FOLDER}")
    query = (
        arrivals.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def due_days(raw: commits.State, landed: commits.State) -> list[date]:
    """Days whose raw run is not the one that was landed."""

    def read_from(day: date) -> str | None:
        return landed.days[day].notes.get("from") if day in landed.days else None

    return sorted(day for day, entry in raw.days.items() if read_from(day) != entry.run)


def land_days(
    spark: SparkSession, source: str, raw: commits.State, schema: StructType, target: str, days: list[date]
) -> None:
    """Replace days by what a state of the raw layer has of them, ledger entries included."""

    hashes = tables.written_hashes(spark, target, schema)

    def entries(run: str, found: list[date]) -> dict[date, dict]:
        counted = hashes(run, found)
        return {day: {"from": raw.days[day].run, **counted.get(day, NOTHING)} for day in days}

    rows = read_transactions(spark, source, schema, days, raw)
    tables.write_days(rows, target, days, aligned=True, notes=entries)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """day, raw_run, row_count, row_hash of everything that has been landed; days that were emptied have no rows."""
    rows = [
        (day, entry.notes["from"], entry.notes["rows"], entry.notes["hash"])
        for day, entry in sorted(commits.state(spark, target).days.items())
    ]
    return spark.createDataFrame(rows, "day date, raw_run string, row_count long, row_hash string")


def damaged_days(spark: SparkSession, target: str, schema: StructType) -> list[date]:
    """Days whose landed files no longer hold what the ledger says."""
    held = commits.state(spark, target)
    now = tables.day_hashes(tables.read_partitioned(spark, target, schema))
    return sorted(day for day, entry in held.days.items() if {k: entry.notes[k] for k in NOTHING} != now.get(day, NOTHING))


def read_landed(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """All landed rows."""
    return tables.read_partitioned(spark, target, schema)
