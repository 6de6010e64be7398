"""What several operators share: words, held-out splits, stored intermediate tables, sums over all tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.session import discard, fresh_dir

#: Rows an Arrow batch holds at most: whole texts are long, and a worker keeps one batch in memory.
BATCH_ROWS = 512
#: Partial sums that the driver may take from tasks at once.
DRIVER_PARTS = 64
#: Python's bytes.split() and bytes.lower() use exactly these six separators and only A-Z.
SEPARATORS = b" \t\n\v\f\r"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators need on a session made elsewhere."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # workers import this package from where the driver has it, if they see that folder
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that only lead to a result, which is stored, too; with the result they go."""

    def __init__(self) -> None:
        self.paths: dict[DataFrame, str] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        path = fresh_dir(spark, name)
        df.write.parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
        self.paths[table] = path
        return table

    def discard(self, *tables: DataFrame) -> None:
        """Remove these tables, or all; nothing that is still to be computed may need them."""
        for table in tables or list(self.paths):
            discard(table.sparkSession, self.paths.pop(table))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids give -1, which is in no held-out part."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(-1))


def text_hash(column: str = "text") -> Column:
    """128 bits that stand for a text; NULL for NULL."""
    return F.substring(F.unhex(F.sha2(F.col(column).cast("binary"), 256)), 1, 16)


def words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8 bytes."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case; other letters stay."""
    return text.encode().lower().split() if text else []


def map_rows(
    df: DataFrame, work: Callable[[Iterable[dict[str, list]]], Iterator[dict[str, list]]], schema: str
) -> DataFrame:
    """mapInArrow with batches as dicts of Python lists."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(batch.to_pydict() for batch in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[field.name], type=field.type) for field in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def gathered(df: DataFrame, merge: Callable, schema: str, most: int = DRIVER_PARTS) -> list:
    """Rows of partial sums, merged task by task in a tree until the driver can take them.

    merge: like the work of map_rows, from batches of partial sums to one row per task. most: rows to end with.
    """
    parts = df.rdd.getNumPartitions()
    while parts > most:
        parts = max(most, parts // DRIVER_PARTS)
        df = map_rows(df.repartition(parts), merge, schema)
    return df.collect()



def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """The rows with rank (from 0 within their group, by order, NULLs first) and total (rows of the group).

    No task holds a group: rows are sorted over all tasks by ranges, and only the numbers of rows of a group in each
    range are added up. Rows that tie in all of order may end up in different ranges. The result is read from a table.
    """
    columns = [*group, *order]
    ids = df.withColumn("_id", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (*columns, "_id")]
    ranges = ids.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_id")
    ranges = stored(ranges.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
    parts = ranges.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(
        *[F.col(c).alias(f"_of_{c}") for c in group], F.col("_part").alias("_in"), "_first", before.alias("_before"), F.sum("_n").over(own).alias("total")
    )
    same = [F.col("_part") == F.col("_in"), *[F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]]
    found = ranges.join(parts, reduce(Column.__and__, same))
    return found.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), "total")
