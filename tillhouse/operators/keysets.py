"""Which stored days may hold a key: ranges of keys and Bloom filters, kept beside a table by day.

A day's keys have a number, a smallest and a largest value, noted with the day, and a filter with about ten bits for each key,
stored as a table of one row per day. A new day is compared with old ones in three steps, each of which leaves fewer days: those whose range
meets the new keys' range, those whose filter knows one of the new keys, and only of these the keys themselves.
Filters have no false negatives, so nothing is missed; a crowded filter costs a look at its day.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.layout import DAY_KEYS, day_values

#: Bits per key, and bits that a key sets: one other key in a hundred is known by mistake.
BITS_PER_KEY, HASHES = 10, 4
#: Filters have 2**SMALLEST to 2**LARGEST bits, 128 bytes to 16 MB; of days that crowd the largest more are looked at.
SMALLEST, LARGEST = 10, 27
#: Filters that a task holds at once while it makes them.
HELD = 16
#: Bytes of filters that new keys are looked up in at once: some hundred days of 100,000 keys.
HELD_BYTES = 64 * 1024 * 1024

FILTERS = T.StructType([T.StructField("bits", T.BinaryType(), True)])


def size_of(keys: int) -> int:
    """The exponent of a filter's number of bits."""
    return min(LARGEST, max(SMALLEST, (BITS_PER_KEY * keys - 1).bit_length()))


def _mixed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the hashes of each key start from and go on by, whatever the filter's size."""
    mixed = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed, (mixed * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    """Bits of each key in a filter of 2**size, one row per hash."""
    mixed, step = _mixed(keys)
    return np.stack([(mixed + np.uint64(i) * step) >> np.uint64(64 - size) for i in range(HASHES)]).astype(np.int64)


def _fill(bits: np.ndarray, keys: np.ndarray) -> None:
    for places in _places(keys, len(bits).bit_length() - 1):
        bits[places] = True


def _filled(keys: np.ndarray, size: int) -> np.ndarray:
    bits = np.zeros(1 << size, dtype=bool)
    _fill(bits, keys)
    return bits


def _by_day(batch: pa.RecordBatch, key: str) -> Iterator[tuple[tuple, np.ndarray]]:
    """Days and their keys; the keys stay in Arrow's memory, only the days become Python's."""
    rows = pa.Table.from_batches([batch]).filter(batch.column(0).is_valid())
    days = rows.group_by(DAY_KEYS).aggregate([(key, "list")])
    own = zip(*[days.column(name).to_pylist() for name in DAY_KEYS], strict=True)
    for day, keys in zip(own, days.column(f"{key}_list"), strict=True):
        yield day, keys.values.to_numpy()


def day_filters(rows: DataFrame, key: str, counts: dict[date, int]) -> DataFrame:
    """bits and day keys: a filter of the keys of each day, by their number.

    Filters of parts of a day are made where the rows are, then merged.
    """
    sizes = {day_values(day): size_of(n) for day, n in counts.items()}
    kind = T.StructType([*FILTERS.fields, *[T.StructField(name, T.StringType(), True) for name in DAY_KEYS]])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for day, keys in _by_day(batch, key):
                if day not in held:
                    held[day] = np.zeros(1 << sizes[day], dtype=bool)
                _fill(held[day], keys)
                if len(held) > HELD:
                    yield out(held)
                    held = {}
        yield out(held)

    def out(held: dict[tuple, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array([np.packbits(bits).tobytes() for bits in held.values()], type=pa.binary())]
        columns += [pa.array([day[i] for day in held], type=pa.string()) for i in range(len(DAY_KEYS))]
        return pa.RecordBatch.from_arrays(columns, names=kind.fieldNames())

    def merge(key_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((1 << sizes[tuple(k.as_py() for k in key_)]) // 8, dtype=np.uint8)
        for batch in batches:
            for part in batch.column("bits"):
                bits |= np.frombuffer(part.as_buffer(), dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], type=pa.binary()), *[pa.array([k.as_py()]) for k in key_]], names=kind.fieldNames())

    parts = rows.select(F.col(key).cast("long").alias(key), *DAY_KEYS).mapInArrow(make, kind)
    return parts.groupBy(*DAY_KEYS).applyInArrow(merge, kind)


def key_ranges(rows: DataFrame, key: str) -> dict[date, dict]:
    """Number, smallest and largest of the keys of each day; one row per day is collected."""
    found = rows.groupBy(*DAY_KEYS).agg(F.count(key).alias("keys"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
    return {date(int(r.year), int(r.month), int(r.day)): {"keys": r["keys"], "low": r.low, "high": r.high} for r in found}


def meeting_days(noted: dict[date, dict], low: int, high: int) -> list[date]:
    """Days whose range of keys meets the given one; days without a key have none."""
    return sorted(day for day, n in noted.items() if n.get("low") is not None and n["low"] <= high and n["high"] >= low)


def portions(sizes: list[tuple[tuple, int]], most: int) -> list[list[tuple]]:
    """Days, with the bytes of their filters, in groups of at most that many bytes; a larger filter is a group by itself."""
    out: list[list[tuple]] = []
    held = 0
    for day, size in sizes:
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append(day)
        held += size
    return out


def known_days(keys: DataFrame, key: str, filters: DataFrame) -> list[date]:
    """Days whose filter knows some of the keys.

    A task holds some filters at a time, of any number of days, and looks its keys up in them: what moves are the filters, one
    row per day, and what comes back are days. keys is read once for every HELD_BYTES of filters.
    """
    spark = filters.sparkSession
    sizes = [((r.year, r.month, r.day), r.size) for r in filters.select(*DAY_KEYS, F.length("bits").alias("size")).collect()]
    found: set[tuple] = set()
    for part in portions(sorted(sizes), HELD_BYTES):
        chosen = filters.filter(F.concat_ws("-", *DAY_KEYS).isin(["-".join(day) for day in part])).collect()
        shared = spark.sparkContext.broadcast({tuple(row[name] for name in DAY_KEYS): bytes(row.bits) for row in chosen})

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hits: set[tuple] = set()
            for batch in batches:
                own = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
                mixed, step = _mixed(own)
                for day, packed in shared.value.items():
                    if day not in hits:
                        bits = np.frombuffer(packed, dtype=np.uint8)
                        shift = np.uint64(65 - (8 * len(bits)).bit_length())
                        # a key goes on to the next hash only if the one before knows it
                        left, by = mixed, step
                        for i in range(HASHES):
                            at = ((left + np.uint64(i) * by) >> shift).astype(np.int64)
                            known = (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
                            left, by = left[known], by[known]
                        if len(left):
                            hits.add(day)
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in hits], type=pa.string()) for i in range(3)], names=DAY_KEYS)

        hits = keys.select(F.col(key).cast("long")).mapInArrow(look, "year string, month string, day string").distinct().collect()
        found |= {tuple(row) for row in hits}
        shared.unpersist()
    return sorted(date(*map(int, day)) for day in found)


def repeated_keys(new: DataFrame, old: DataFrame | None, key: str) -> DataFrame:
    """Keys that occur twice within new, or in new and in old, with their number of rows."""
    own = new.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    if old is None:
        return own.filter("n_records > 1")
    counted = old.join(own.select(key), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("others"))
    both = own.join(counted, key, "left").select(key, (F.col("n_records") + F.coalesce("others", F.lit(0))).alias("n_records"))
    return both.filter("n_records > 1")
