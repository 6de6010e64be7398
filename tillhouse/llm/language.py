"""Language identification by the nearest of several centroids per language.

A text becomes the normalised TF-IDF vector of its hashed letter 2-grams and 3-grams: letters in lower case, each
run of other characters one separator. Document frequencies come from all training documents. The centroids of a
language are fitted by spherical k-means on a bounded sample of its training documents. A text gets the language
of the centroid with the largest cosine, and is rejected when that cosine is far below what most training texts of
that language and of about its length reach; odd training texts do not move that limit.

Defined results: NULL texts and texts without a letter are `und` with score 0 and rejected. Equal cosines go to the
language that sorts first. Without training documents everything is `und`. Very long texts are read whole, in slices. Rows that
repeat an id and a text are one training document of the sample, and each gets its own result; NULL ids are ids like others.
Columns other than id, text and language take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import gathered, map_rows

DIMENSIONS = 1 << 14
CLUSTERS = 4
#: Training documents per language that the centroids are fitted on.
SAMPLE_DOCUMENTS = 400
#: A text is rejected below this share of the median cosine of its language's training texts of its length.
REJECT_SHARE = 0.3
SLICE = 1 << 20
LENGTH_BINS = 40
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # DIMENSIONS x centroids, unit columns
    idf: np.ndarray
    floors: np.ndarray  # of each centroid, smallest accepted cosine by log2 of the number of n-grams


@cache
def _letters() -> np.ndarray:
    """Lower-case code of each letter of the basic plane, 0 for all else."""
    codes = np.zeros(1 << 16, dtype=np.uint32)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            codes[code] = ord(lower) if len(lower) == 1 else code
    return codes


def _high(codes: np.ndarray) -> np.ndarray:
    """The same beyond the basic plane."""
    distinct, inverse = np.unique(codes, return_inverse=True)
    return np.array([ord(chr(code).lower()[0]) if chr(code).isalpha() else 0 for code in distinct.tolist()], dtype=np.uint32)[inverse]


def grams(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of the whole text; all zero without a letter."""
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    table = _letters()
    for start in range(0, len(text), SLICE):
        # two characters more, for the n-grams across the slice's end
        codes = np.frombuffer(text[start : start + SLICE + 2].encode("utf-32-le", "replace"), dtype="<u4")
        high = codes > 0xFFFF
        codes = table[np.minimum(codes, 0xFFFF)] if not high.any() else np.where(high, _high(codes), table[np.minimum(codes, 0xFFFF)])
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        codes = np.concatenate([[0], codes[keep], [0]]).astype(np.uint32)
        pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA6B)
        triples = pairs[:-1] * np.uint32(0xC2B2AE35) + codes[2:] * np.uint32(0x27D4EB2F)
        some = codes[1:-1] != 0
        for hashed in (pairs[:-1][some], triples[some]):
            counts += np.bincount((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(18), minlength=DIMENSIONS)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and unit-length weights."""
    at = np.flatnonzero(counts)
    weights = (1 + np.log(counts[at])) * idf[at]
    return at, weights / (np.linalg.norm(weights) or 1.0)


def _bin(n: int) -> int:
    return min(LENGTH_BINS - 1, int(n).bit_length())


def _frequencies(training: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training documents, and in how many of them each n-gram occurs."""

    def count(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        n, seen = 0, np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            n += len(batch["text"])
            for text in batch["text"]:
                seen += grams(text) > 0
        yield {"n": [n], "seen": [seen.tobytes()]}

    def merge(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        n, seen = 0, np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            n += sum(batch["n"])
            for part in batch["seen"]:
                seen += np.frombuffer(part, dtype=np.int64)
        yield {"n": [n], "seen": [seen.tobytes()]}

    schema = "n long, seen binary"
    rows = gathered(map_rows(training.select("text"), count, schema), merge, schema)
    return sum(row.n for row in rows), sum((np.frombuffer(row.seen, dtype=np.int64) for row in rows), np.zeros(DIMENSIONS, dtype=np.int64))


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean direction and then the vector farthest from all centres so far."""

    def unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)

    centres = [vectors[np.argmax(vectors @ unit(vectors.mean(0)))]]
    while len(centres) < min(k, len(vectors)):
        nearest = (vectors @ np.array(centres).T).max(1)
        if nearest.min() > 1 - 1e-9:
            break
        centres.append(vectors[np.argmin(nearest)])
    centres = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        centres = unit(np.array([vectors[own == i].mean(0) if (own == i).any() else centres[i] for i in range(len(centres))]))
    return centres


def smallest(hashes: DataFrame, most: int) -> dict[str, int]:
    """For each language the largest of its smallest hashes, of which there are at most so many. hashes: lang, h.

    A task hands on as many of each language as are wanted in all, and tasks are merged in a tree.
    """

    def merged(parts: Iterable[tuple[str, Iterable[int]]]) -> dict[str, list]:
        held: dict[str, set[int]] = {}
        for lang, own in parts:
            kept = held.setdefault(lang, set())
            kept.update(own)
            if len(kept) > 4 * most:
                held[lang] = set(sorted(kept)[:most])
        return {"lang": list(held), "hashes": [sorted(kept)[:most] for kept in held.values()]}

    def first(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        yield merged((lang, (h,)) for batch in batches for lang, h in zip(batch["lang"], batch["h"], strict=True))

    def merge(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        yield merged(part for batch in batches for part in zip(batch["lang"], batch["hashes"], strict=True))

    schema = "lang string, hashes array<long>"
    rows = gathered(map_rows(hashes, first, schema), merge, schema, 1)
    return {row.lang: row.hashes[-1] for row in rows}


def train(training: DataFrame, per_language: int = SAMPLE_DOCUMENTS, clusters: int = CLUSTERS) -> Model | None:
    """Learn from rows (doc_id, text, lang).

    Gathered in one task: the sample of one language, per_language different texts. On the driver: one row per language and
    cluster.
    """
    training = training.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    n, seen = _frequencies(training)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + seen)) + 1

    # the texts with the smallest hashes of each language; a text that repeats under one id has one hash, and counts once
    hashed = training.withColumn("h", F.xxhash64("doc_id", "text"))
    limits = smallest(hashed.select("lang", "h"), per_language)
    # one number per language, so texts are filtered where they are read
    last = F.create_map(*[F.lit(x) for item in limits.items() for x in item])
    sample = hashed.filter(F.col("h") <= last[F.col("lang")])

    def vectors(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            made = [vector(counts, idf) + (int(counts.sum()),) for counts in map(grams, batch["text"])]
            yield {
                "lang": batch["lang"],
                "h": batch["h"],
                "at": [at.astype("<i4").tobytes() for at, _, _ in made],
                "weights": [w.astype("<f4").tobytes() for _, w, _ in made],
                "n": [n for _, _, n in made],
            }

    def centroids(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows.n > 0].sort_values(["n", "at"])
        if not len(rows):
            return pd.DataFrame({"lang": [], "centroid": [], "floors": []})
        dense = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
        for i, (at, weights) in enumerate(zip(rows["at"], rows["weights"], strict=True)):
            dense[i, np.frombuffer(at, dtype="<i4")] = np.frombuffer(weights, dtype="<f4")
        found = cluster(dense, clusters)
        cosines = (dense @ found.T).max(1)
        bins = np.array([_bin(n) for n in rows["n"]])
        floors = np.zeros(LENGTH_BINS)
        for i in range(LENGTH_BINS):
            # a length that the sample lacks takes the floor of the next shorter one, and shorter ones accept all
            floors[i] = REJECT_SHARE * np.median(cosines[bins == i]) if (bins == i).any() else floors[max(0, i - 1)]
        return pd.DataFrame(
            {
                "lang": [rows["lang"].iloc[0]] * len(found),
                "centroid": [c.astype("<f4").tobytes() for c in found],
                "floors": [floors.tobytes()] * len(found),
            }
        )

    texts = map_rows(sample.select("lang", "h", "text"), vectors, "lang string, h long, at binary, weights binary, n long")
    texts = texts.groupBy("lang", "h").agg(F.min(F.struct("at", "weights", "n")).alias("one")).select("lang", "one.*")
    rows = texts.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, floors binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda row: (row.lang, bytes(row.centroid)))
    floors = np.array([np.frombuffer(row.floors) for row in rows])
    matrix = np.array([np.frombuffer(row.centroid, dtype="<f4") for row in rows]).T.copy()
    return Model([row.lang for row in rows], matrix, idf, floors)


def classify(text: str | None, model: Model | None) -> tuple[str, float, bool]:
    """Language, cosine with its nearest centroid (0 to 1), whether it is rejected."""
    counts = grams(text) if text and model is not None else None
    if counts is None or not (n := int(counts.sum())):
        return UNKNOWN, 0.0, True
    at, weights = vector(counts, model.idf)
    cosines = weights @ model.centroids[at]
    best = int(np.argmax(cosines))
    score = float(min(1.0, max(0.0, cosines[best])))
    return model.languages[best], score, score < model.floors[best, _bin(n)]


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every document; one pass, no shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows = [classify(text, shared.value) for text in batch["text"]]
            yield {"doc_id": batch["doc_id"]} | {
                name: [row[i] for row in rows] for i, name in enumerate(("lang_pred", "score", "rejected"))
            }

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_known(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents that are not rejected, with all their columns, whatever these are called; repeated rows are judged alike.

    Texts that are NULL or without a letter go. Without a model nothing is known to reject, and all documents stay.
    """
    if model is None:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [not classify(text, shared.value)[2] for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
