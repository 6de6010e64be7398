"""Nearest neighbours by largest inner product, on several shifted Hilbert curves.

One more component makes every vector's length the largest length M (a query gets 0 there), so that the largest
inner product is the smallest distance. Each of CURVES curves projects the vectors on AXES random directions, shifts and
quantises them, and orders them by their place on a Hilbert curve; Spark range-partitions and sorts by it. A query is
compared, in double precision on the original vectors, with all rows whose rank on a curve is within the window
of its own; the results of the curves are merged and ranked again.

The window is not a constant: for SAMPLE queries the true neighbours are found among all rows, and the window is the
smallest in which a share of COVERED of them lies on their nearest curve. Vectors without structure get wide windows,
up to all rows; clustered ones get narrow ones. What is fitted on samples: the projections' mean and spread (FITTED
rows) and the window. Every row is indexed.

Vectors that are equal are one class with its smallest ids, so ties go to the smallest vec_id, and a class of very many
copies is one row of the index. Blocks of equal numbers of rows are compared, whatever the keys are.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part; nor do NULL
ids. Rows that repeat an id and vector count once. An id with several vectors is one query with the best answers of
them all, and a candidate with each of them. Columns other than id and vector take no part. If lengths differ, only vectors of the most frequent length (the
longer of equals) take part. An empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import map_rows, stored

K, EVERY = 20, 20
CURVES, AXES, BITS = 16, 8, 7
SAMPLE, COVERED = 192, 0.95
FITTED = 4096
#: Least rows of a block.
BLOCK = 1024


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (row of AXES coordinates) on the Hilbert curve, by undoing rotations from the top bit down."""
    axes = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        below = bit - one
        for axis in axes:
            on = (axis & bit) != 0
            swap = np.where(on, np.uint64(0), (axes[0] ^ axis) & below)
            axes[0] ^= np.where(on, below, swap)
            axis ^= swap
    for previous, axis in zip(axes, axes[1:], strict=False):
        axis ^= previous
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        flip ^= np.where((axes[-1] & bit) != 0, bit - one, np.uint64(0))
    axes ^= flip
    place = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = place << one | axis >> np.uint64(level) & one
    return place.astype(np.int64)


class Curves:
    """Projections, shifts and scales of all curves."""

    def __init__(self, dimensions: int, longest: float, sample: np.ndarray):
        random = np.random.default_rng(6)
        self.longest = longest
        self.directions = random.standard_normal((dimensions + 1, CURVES * AXES))
        self.shifts = random.random(CURVES * AXES)
        seen = self._extended(sample, False) @ self.directions
        self.mean, self.spread = seen.mean(0), np.maximum(seen.std(0), 1e-12)

    def _extended(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        lengths = np.linalg.norm(vectors, axis=1)
        if queries:
            return np.hstack([vectors * (self.longest / lengths)[:, None], np.zeros((len(vectors), 1))])
        return np.hstack([vectors, np.sqrt(np.maximum(0.0, self.longest**2 - lengths**2))[:, None]])

    def places(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """Rows x CURVES."""
        at = (self._extended(vectors, queries) @ self.directions - self.mean) / self.spread
        # near the normal distribution's ranks, so that cells hold about equally many
        level = (1 / (1 + np.exp(-1.702 * np.clip(at, -30, 30))) + self.shifts) / 2
        cells = np.minimum((level * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        return np.stack([hilbert(cells[:, c * AXES : (c + 1) * AXES], BITS) for c in range(CURVES)], axis=1)


def _matrix(values: Iterable[bytes]) -> np.ndarray:
    values = list(values)
    return np.frombuffer(b"".join(values), dtype="<f8").reshape(len(values), -1) if values else np.empty((0, 0))


def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector (as bytes of doubles), size, length of the rows that take part."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("vec_id", "vector", "size", "length")}
            for vec_id, components in zip(batch["vec_id"], batch["embedding"], strict=True):
                if vec_id is None or not components or None in components:
                    continue
                vector = np.array(components, dtype="<f8") + 0.0  # no negative zeros
                length = float(np.linalg.norm(vector))
                if np.isfinite(length) and length > 0:
                    for c, value in zip(out, (vec_id, vector.tobytes(), len(vector), length), strict=True):
                        out[c].append(value)
            yield out

    return map_rows(embeddings.select("vec_id", "embedding"), work, "vec_id long, vector binary, size int, length double")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores and of all equal to the last, ties in no order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])


def _exact(classes: DataFrame, queries: list, k: int) -> DataFrame:
    """asked, cls of the true nearest classes of a few queries, against all rows."""
    vectors = _matrix(row.vector for row in queries)
    names = [row.cls for row in queries]

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: dict = {}
        for batch in batches:
            if batch["cls"]:
                scores = vectors @ _matrix(batch["vector"]).T
                for query, row in zip(names, scores, strict=True):
                    found = [(row[i], batch["cls"][i]) for i in _best(row, None, k + 1)] + held.get(query, [])
                    held[query] = sorted(found, key=lambda x: (-x[0], x[1]))[: k + 1]
        rows = [(query, cls, score) for query, found in held.items() for score, cls in found]
        yield {c: [row[i] for row in rows] for i, c in enumerate(("query", "cls", "score"))}

    found = map_rows(classes.select("cls", "vector"), work, "query long, cls long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cls"))
    return found.filter("query <> cls").withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("query").alias("asked"), "cls")


def _positions(rows: DataFrame) -> DataFrame:
    """Rank of each row (curve, place, cls, query, vector) on its curve, from 0."""
    order = ["curve", "place", "cls", "query"]
    # ids that grow along each sorted partition are stored, so they stay what they are
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("n", F.monotonically_increasing_id()), "curves")
    part = F.shiftright("n", 33)
    parts = ordered.groupBy("curve", part.alias("part")).agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("curve", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("base"))
    return ordered.withColumn("part", part).join(stored(parts, "parts"), ["curve", "part"]).withColumn("rank", F.col("n") + F.col("base")).drop("n", "part", "base")


def _window(ranked: DataFrame, classes: DataFrame, k: int) -> int:
    """Ranks that a query must look to each side."""
    asked = ranked.filter("query and curve = 0").orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("cls", "vector").collect()
    truth = stored(_exact(classes, asked, k), "truth")
    # a few thousand rows: SAMPLE queries with k neighbours on CURVES curves
    one = F.broadcast(truth.select("asked").distinct())
    own = ranked.filter("query").join(one, F.col("cls") == F.col("asked")).select("asked", "curve", F.col("rank").alias("own"))
    other = ranked.filter("not query").join(F.broadcast(truth), "cls").select("asked", "cls", "curve", "rank")
    away = other.join(own, ["asked", "curve"]).groupBy("asked", "cls").agg(F.min(F.abs(F.col("rank") - F.col("own"))).alias("away"))
    found = away.agg(F.percentile("away", F.lit(COVERED)).alias("w")).first()
    return int(np.ceil(found.w or 0)) + k


def search(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found of each row whose id is divisible by `every`."""
    spark = embeddings.sparkSession
    rows = stored(_usable(embeddings), "vectors")
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).orderBy(F.desc("n"), F.desc("size")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.col("size") == sizes["size"]).select("vec_id", "vector").distinct()

    # equal vectors: the smallest ids of each class, one more than asked for
    inside = Window.partitionBy("vector").orderBy("vec_id")
    members = rows.withColumn("place", F.row_number().over(inside)).filter(F.col("place") <= k + 1)
    members = stored(members.select("vec_id", "vector", F.min("vec_id").over(Window.partitionBy("vector")).alias("cls")), "members")
    classes = members.filter("vec_id = cls").select("cls", "vector")
    names = classes.select(F.col("cls"), "vector")
    queries = stored(rows.filter(F.col("vec_id") % every == 0).join(names, "vector").select("vec_id", "cls"), "queries")

    sample = _matrix(row.vector for row in classes.orderBy(F.xxhash64("cls"), "cls").limit(FITTED).collect())
    curves = spark.sparkContext.broadcast(Curves(sizes["size"], sizes["longest"], sample))

    def placed(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            n = len(batch["cls"])
            if not n:
                continue
            vectors = _matrix(batch["vector"])
            asked = np.array(batch["asked"], dtype=bool)
            for query in (False, True):
                at = np.flatnonzero(asked) if query else np.arange(n)
                if len(at):
                    yield {
                        "curve": np.tile(np.arange(CURVES, dtype=np.int32), len(at)),
                        "place": curves.value.places(vectors[at], query).ravel(),
                        "cls": np.repeat(np.array(batch["cls"])[at], CURVES),
                        "query": np.full(len(at) * CURVES, query),
                        "vector": [batch["vector"][i] for i in at for _ in range(CURVES)],
                    }

    asked = queries.select("cls").distinct().withColumn("asked", F.lit(True))
    marked = classes.join(asked, "cls", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    ranked = stored(_positions(map_rows(marked, placed, "curve int, place long, cls long, query boolean, vector binary")), "ranked")
    window = _window(ranked, classes, k)
    block = max(BLOCK, window)

    here = F.floor(F.col("rank") / block)
    candidates = ranked.filter("not query").select("curve", here.alias("block"), "rank", "cls", "vector")
    reach = F.explode(F.sequence(F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / block), F.floor((F.col("rank") + window) / block)))
    asking = ranked.filter("query").select("curve", reach.alias("block"), "rank", "cls", "vector")

    def compare(asking: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query": [], "cls": [], "score": []}
        if len(asking) and len(candidates):
            candidates = candidates.sort_values("rank")
            ranks, names = candidates["rank"].to_numpy(), candidates["cls"].to_numpy()
            matrix = _matrix(candidates.vector)
            for query, rank, vector in zip(asking.cls, asking["rank"], asking.vector, strict=True):
                low, high = np.searchsorted(ranks, [rank - window, rank + window + 1])
                scores = matrix[low:high] @ np.frombuffer(vector, dtype="<f8")
                best = _best(scores, names[low:high], k + 1)
                best = best[np.lexsort((names[low:high][best], -scores[best]))][: k + 1]
                out["query"] += [query] * len(best)
                out["cls"] += names[low:high][best].tolist()
                out["score"] += scores[best].tolist()
        return pd.DataFrame(out)

    keys = ["curve", "block"]
    found = asking.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(compare, "query long, cls long, score double")
    found = found.groupBy("query", "cls").agg(F.max("score").alias("score"))
    near = Window.partitionBy("query").orderBy(F.desc("score"), "cls")
    found = stored(found.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k + 1).drop("rank"), "found")

    # classes become rows again: at most k + 1 classes of at most k + 1 ids for each different query
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    expanded = found.join(members.select("cls", "vec_id"), "cls").withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k + 1)
    expanded = stored(expanded.select(F.col("query").alias("cls"), "vec_id", "score"), "expanded")
    answers = queries.withColumnRenamed("vec_id", "query_id").join(expanded, "cls").filter("vec_id <> query_id")
    near = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
