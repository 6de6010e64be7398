"""Type-2 history of the masters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.dates import plain_day_keys


def snapshot_view(master: DataFrame, key: str) -> DataFrame:
    """The master as the history stores it: text key, unpadded day keys of the last change."""
    others = [name for name in master.columns if name != key]
    return master.select(
        F.col(key).cast("string").alias(key), *others, *plain_day_keys(F.col("updated_at"))
    )


def newest_per_key(view: DataFrame, key: str) -> DataFrame:
    """One row per key, should a master ever repeat one: the row changed last."""
    columns = view.columns
    newest = F.max(F.struct("updated_at", *[name for name in columns if name not in (key, "updated_at")]))
    return view.groupBy(key).agg(newest.alias("row")).select(key, "row.*").select(*columns)


def first_load(master: DataFrame, key: str) -> DataFrame:
    """One open version per key, valid from its last change."""
    view = newest_per_key(snapshot_view(master, key), key)
    return view.withColumn("valid_from", F.col("updated_at")).withColumn(
        "valid_to", F.lit(None).cast(view.schema["updated_at"].dataType)
    )


def merge(history: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """History after a later load.

    A key changed after its open version began gets that version closed and a new one added;
    new keys are added; unchanged keys and keys missing from the master keep their open
    version. Closed versions pass through without a shuffle.
    """
    columns = history.columns
    version = F.struct(*columns)
    open_rows = history.filter(F.col("valid_to").isNull()).select(F.col(key), version.alias("old"))
    arriving = first_load(master, key).select(F.col(key), version.alias("new"))
    pairs = open_rows.join(arriving, key, "full")

    changed = F.col("new.updated_at") > F.col("old.valid_from")
    kept = F.when(changed, F.col("old").withField("valid_to", F.col("new.updated_at"))).otherwise(F.col("old"))
    added = F.when(F.col("old").isNull() | changed, F.col("new"))
    versions = pairs.select(F.explode(F.array_compact(F.array(kept, added))).alias("version"))

    closed_rows = history.filter(F.col("valid_to").isNotNull())
    return closed_rows.unionByName(versions.select("version.*"))


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())


def stamp_updated_at(old: DataFrame, new: DataFrame, key: str, now: str) -> DataFrame:
    """New rows with the time of their last change: now where a column differs or the key is new.

    NULL equals NULL, so a value that stays missing is no change.
    """
    columns = new.columns
    tracked = [name for name in columns if name not in (key, "updated_at")]
    before = old.select(
        F.col(key), F.lit(True).alias("known"), F.struct(*tracked).alias("before"), F.col("updated_at").alias("stamped")
    )
    kind = new.schema["updated_at"].dataType
    same = F.col("known").isNotNull() & F.struct(*tracked).eqNullSafe(F.col("before"))
    stamped = F.when(same, F.col("stamped")).otherwise(F.lit(now).cast(kind))
    return new.join(before, key, "left").withColumn("updated_at", stamped).select(*columns)
