"""Best-fit packing of documents into token sequences of a fixed capacity, by linear grouping.

A document is its token ids and one end id. What is longer than the capacity is cut so that the first piece is the
shorter one; full pieces are sequences of their own. All other pieces have one of `capacity - 1` lengths, so the
plan is made on the histogram of lengths, whose size does not depend on the data:

1. Lengths above `small` are sorted and dealt into `groups` of equal cardinality; each is rounded up to the largest
   of its group.
2. Over these few rounded sizes, configurations (how many of each size share a sequence) are chosen one after
   another, the fullest first, each as often as the remaining counts allow.
3. Actual pieces take the places of their group in descending order, which leaves room where they are shorter.
4. Small pieces go where they fit best, largest first; what fits nowhere opens sequences filled in the same way.

The plan is a list of segments (length, first rank, first sequence, offset, count): pieces of one length are ranked
in Spark, and each finds its place by its rank. Only the plan is broadcast.

Defined results: a NULL or empty text is a document of just the end id. Repeated rows and repeated ids are packed
one by one; with equal ids and texts it is open which row gets which place. An empty table gives no rows. Very long
texts are encoded whole and give many pieces. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.bytepair import encoder
from tillhouse.llm.common import map_rows, stored

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END = 2
#: Equal-cardinality groups of large lengths, and the largest length that counts as small, as a share of the capacity.
GROUPS = 300
SMALL_SHARE = 8
#: Pieces ranked by one task.
RANKED_TOGETHER = 200_000


class Segment(NamedTuple):
    """Pieces of this length with ranks from `rank` on, `count` of them: one each in sequences from `first` on."""

    length: int
    rank: int
    first: int
    offset: int
    count: int


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths in descending order dealt into groups of equal cardinality, as (length, count) runs.

    A length that fills a whole group alone has one of its own; it needs no rounding.
    """
    per_group = max(1, -(-sum(counts.values()) // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        if room <= 0 or counts[length] >= per_group:
            out.append([])
            room = per_group
        out[-1].append((length, counts[length]))
        room -= counts[length]
    return out


def _fullest(sizes: list[int], left: list[int], largest: int, capacity: int) -> list[int]:
    """How many of each size fill a sequence best, with one of the largest size that is left.

    Bounded knapsack over the room that remains: best[r] is the fullest filling of r found with the sizes so far.
    """
    room = capacity - sizes[largest]
    reachable = 1  # bit r: some filling of the sizes so far is r
    steps = []
    mask = (1 << (room + 1)) - 1
    for i in range(largest, len(sizes)):
        spare = left[i] - (i == largest)
        spare = min(spare, room // sizes[i])
        before = reachable
        copies = 1
        while spare > 0:  # binary splitting of the copies
            take = min(copies, spare)
            reachable |= (reachable << (take * sizes[i])) & mask
            spare -= take
            copies *= 2
        if reachable != before:
            steps.append((i, before))
        if reachable >> room & 1:
            break
    filled = reachable.bit_length() - 1
    pattern = [0] * len(sizes)
    pattern[largest] = 1
    for i, before in reversed(steps):
        while not before >> filled & 1:
            filled -= sizes[i]
            pattern[i] += 1
    return pattern


def configurations(sizes: list[int], counts: list[int], capacity: int) -> Iterator[tuple[list[int], int]]:
    """Configurations of descending sizes and how often each is used, until no piece is left."""
    left = list(counts)
    largest = 0
    while True:
        while largest < len(sizes) and not left[largest]:
            largest += 1
        if largest == len(sizes):
            return
        pattern = _fullest(sizes, left, largest, capacity)
        times = min(left[i] // n for i, n in enumerate(pattern) if n)
        yield pattern, times
        for i, n in enumerate(pattern):
            left[i] -= n * times


class _Stock:
    """The pieces of a group, longest first, taken in runs of one length."""

    def __init__(self, runs: list[tuple[int, int]], ranks: dict[int, int]):
        self.runs = list(reversed(runs))
        self.ranks = ranks

    def take(self, n: int) -> Iterator[tuple[int, int, int]]:
        """(length, first rank, count) of the next n pieces."""
        while n:
            length, left = self.runs.pop()
            count = min(n, left)
            yield length, self.ranks[length], count
            self.ranks[length] += count
            n -= count
            if left > count:
                self.runs.append((length, left - count))


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[Segment], int]:
    """Segments that place every piece, and the number of sequences."""
    small = capacity // SMALL_SHARE
    large = {length: n for length, n in counts.items() if length > small and n}
    segments: list[Segment] = []
    ranks: dict[int, int] = defaultdict(int)
    groups_ = grouped(large, groups)
    stocks = [_Stock(runs, ranks) for runs in groups_]
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: runs (first sequence, count)
    used = 0

    def place(first: int, times: int, slots: list[list[tuple[int, int, int]]]) -> None:
        """Sequences first..first+times; slots: for each place, the runs of pieces that fill it."""
        cuts = sorted({0, times} | {c for runs in slots for c in np.cumsum([n for _, _, n in runs]).tolist()})
        at = [[0, 0] for _ in slots]  # run, taken of it
        for a, b in zip(cuts, cuts[1:], strict=False):
            offset = 0
            for k, runs in enumerate(slots):
                run, taken = at[k]
                length, rank, n = runs[run]
                segments.append(Segment(length, rank + taken, first + a, offset, b - a))
                offset += length
                taken += b - a
                at[k] = [run + 1, 0] if taken == n else [run, taken]
            rooms[capacity - offset].append((first + a, b - a))

    for pattern, times in configurations([runs[0][0] for runs in groups_], [sum(n for _, n in runs) for runs in groups_], capacity):
        slots = [list(stocks[i].take(times)) for i, n in enumerate(pattern) for _ in range(n)]
        place(used, times, slots)
        used += times

    # best fit, largest small pieces first, into the smallest room that holds them
    open_rooms = sorted(room for room in rooms if room)
    for length in sorted((n for n in counts if n <= small and counts[n]), reverse=True):
        left = counts[length]
        while left:
            i = bisect.bisect_left(open_rooms, length)
            if i == len(open_rooms):
                # a new sequence for as many as fit in it
                new = -(-left // (capacity // length))
                rooms[capacity].append((used, new))
                bisect.insort(open_rooms, capacity)
                used += new
                continue
            room = open_rooms[i]
            first, count = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                open_rooms.pop(i)
            fit = min(count, left)
            segments.append(Segment(length, ranks[length], first, capacity - room, fit))
            ranks[length] += fit
            left -= fit
            for rest, start, n in ((room - length, first, fit), (room, first + fit, count - fit)):
                if rest and n:
                    if rest not in rooms:
                        bisect.insort(open_rooms, rest)
                    rooms[rest].append((start, n))
    return segments, used


class Placement:
    """The plan, looked up by length and rank."""

    def __init__(self, segments: list[Segment]):
        by_length: dict[int, list[Segment]] = defaultdict(list)
        for segment in segments:
            by_length[segment.length].append(segment)
        self.by_length = {n: np.array(sorted((s.rank, s.first, s.offset) for s in own), dtype=np.int64).T for n, own in by_length.items()}

    def find(self, length: int, rank: int) -> tuple[int, int]:
        starts, firsts, offsets = self.by_length[length]
        i = int(np.searchsorted(starts, rank, side="right")) - 1
        return int(firsts[i] + rank - starts[i]), int(offsets[i])


def encoded(documents: DataFrame, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """doc_id, n (ids), first (length of the first piece if it is not full, else 0), crcs (of each piece)."""
    tail = end.to_bytes(4, "little")

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        ids = encoder(tokenizer).ids
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n": [], "first": [], "crcs": []}
            for text in batch["text"]:
                data = memoryview(ids(text or "") + tail)
                n = len(data) // 4
                first = n % capacity
                ends = range(first, n + 1, capacity) if first else range(capacity, n + 1, capacity)
                out["n"].append(n)
                out["first"].append(first)
                out["crcs"].append([zlib.crc32(data[4 * max(0, e - (capacity if i or not first else first)) : 4 * e]) for i, e in enumerate(ends)])
            yield out

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, n long, first int, crcs array<long>")


def pack(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Shuffles one short row per document; texts and ids are not moved.
    """
    spark = documents.sparkSession
    sizes = stored(encoded(documents, tokenizer, capacity, end), "packing")
    shares = max(8, -(-sizes.count() // RANKED_TOGETHER))
    sizes = sizes.withColumn("share", F.pmod(F.xxhash64("doc_id", "n", "crcs"), F.lit(shares)))
    # one length, or one document's copies, may be most of the rows: shares of a length are ranked apart
    row = F.monotonically_increasing_id()
    sizes = sizes.withColumn("row", row).withColumn("share", F.pmod(F.xxhash64("share", "row"), F.lit(shares)))
    full = F.floor(F.col("n") / capacity)
    groups = sizes.groupBy("first", "share").agg(F.count(F.lit(1)).alias("members"), F.sum(full).alias("full"))
    totals = {r["first"]: (r["members"], r["full"]) for r in groups.groupBy("first").agg(F.sum("members").alias("members"), F.sum("full").alias("full")).collect()}
    segments, used = plan({length: n for length, (n, _) in totals.items() if length}, capacity)
    placement = spark.sparkContext.broadcast(Placement(segments))
    before, taken = {}, used
    for length in sorted(totals):
        before[length] = taken
        taken += totals[length][1]
    bases = spark.createDataFrame([(k, v) for k, v in before.items()], "first int, full_base long")

    earlier = Window.partitionBy("first").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select(
        "first",
        "share",
        F.coalesce(F.sum("members").over(earlier), F.lit(0)).alias("rank_base"),
        F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("full_start"),
    ).join(bases, "first")
    within = Window.partitionBy("first", "share").orderBy("row")
    ranked = sizes.select(
        "*",
        (F.row_number().over(within) - 1).alias("rank_in"),
        (F.sum(full).over(within.rowsBetween(Window.unboundedPreceding, 0)) - full).alias("full_in"),
    )
    placed = ranked.join(starts, ["first", "share"]).select(
        "doc_id",
        "n",
        "first",
        "crcs",
        (F.col("rank_in") + F.col("rank_base")).cast("long").alias("rank"),
        (F.col("full_in") + F.col("full_start") + F.col("full_base")).cast("long").alias("full_at"),
    )

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        find = placement.value.find
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")}
            for doc_id, first, crcs, rank, full_at in zip(*(batch[c] for c in ("doc_id", "first", "crcs", "rank", "full_at")), strict=True):
                at = 0
                for piece, crc in enumerate(crcs):
                    if first and not piece:
                        length, (sequence, offset) = first, find(first, rank)
                    else:
                        length, sequence, offset = capacity, full_at + piece - bool(first), 0
                    for name, value in zip(out, (doc_id, piece, at, length, crc, sequence, offset), strict=True):
                        out[name].append(value)
                    at += length
            yield out

    return map_rows(placed, work, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
