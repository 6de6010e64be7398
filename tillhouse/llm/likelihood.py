"""Document likelihood from a subword lattice.

The vocabulary of an existing piece model gets unigram scores from the training documents: the pieces' shares among
all words' pieces. The probability of a word is the sum over all its segmentations of the product of their pieces'
probabilities, by forward recursion over the lattice of pieces (in log space for long words). A word seen in training is one more arc over
its whole length: P(word) = l * count / N + (1 - l) * lattice, with l = N / (N + V) after Witten and Bell. A document's
score is the sum of the log10 of its tokens' probabilities, the end included.

Words are scored once each, however often they occur. The HOT most frequent ones are broadcast; all others of a
document are joined with the table of words by a shuffle. Only words of more than HOT_BYTES bytes can be frequent there; each
document has one row of such a word, and adaptive execution splits the join.

Defined results: a NULL or empty text is one token, the end. NULL ids are training documents. Without training
documents all pieces are equally likely. Repeated rows are scored one by one. Words are read whole, however long. An
empty table gives no rows. Columns other than id and text take no part, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import pieces
from tillhouse.llm.common import gathered, lower_words, map_rows, remainder, stored

#: Words broadcast with their scores, and the longest among them in bytes.
HOT, HOT_BYTES = 100_000, 48
#: Distinct words a task holds before it hands on their counts.
HELD = 300_000
#: Longer words are summed in log space.
LINEAR = 40
DIVISOR, HELD_OUT = 5, 1


def counted(documents: DataFrame) -> DataFrame:
    """word, c (count in training documents), total (in all) of every word of all documents."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        parts: tuple[Counter, Counter] = (Counter(), Counter())

        def handed() -> Iterator[dict[str, list]]:
            for kind, counts in enumerate(parts):
                if counts:
                    n = list(counts.values())
                    yield {"word": list(counts), "c": [0] * len(n) if kind else n, "total": n}
                    counts.clear()

        for batch in batches:
            for text, held_out in zip(batch["text"], batch["held_out"], strict=True):
                parts[held_out].update(lower_words(text))
                if len(parts[0]) + len(parts[1]) > HELD:
                    yield from handed()
        yield from handed()

    rows = documents.select("text", "held_out").filter(F.col("text").isNotNull())
    found = map_rows(rows, work, "word binary, c long, total long")
    return found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("total").alias("total"))


def piece_counts(words: DataFrame, model: str) -> np.ndarray:
    """How often each piece occurs in the training words, by the piece model's own segmentation."""

    def packed(counts: np.ndarray) -> dict[str, list]:
        return {"counts": [counts.tobytes()]}

    def count(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        library = pieces.encoder(model).library
        counts = np.zeros(library.get_piece_size(), dtype=np.int64)
        for batch in batches:
            found = library.encode([word.decode() for word in batch["word"]], num_threads=1)
            ids = np.fromiter((i for one in found for i in one), dtype=np.int64)
            np.add.at(counts, ids, np.repeat(batch["c"], [len(one) for one in found]))
        yield packed(counts)

    def merge(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        yield packed(sum(np.frombuffer(part, dtype=np.int64) for batch in batches for part in batch["counts"]))

    rows = gathered(map_rows(words.filter("c > 0").select("word", "c"), count, "counts binary"), merge, "counts binary")
    size = pieces.encoder(model).library.get_piece_size()
    return sum((np.frombuffer(row.counts, dtype=np.int64) for row in rows), np.zeros(size, dtype=np.int64))


class Lattice:
    """Marginal probabilities of words under unigram probabilities of the model's pieces."""

    def __init__(self, model: str, probabilities: np.ndarray):
        known = pieces.encoder(model)
        self.automaton, self.longest = known.automaton, known.longest
        self.p = {piece: float(probabilities[i]) for piece, i in known.ids.items()}
        self.bytes_ = [float(probabilities[i]) for i in known.bytes_]

    def _arcs(self, text: str, i: int) -> Iterator[tuple[int, float]]:
        if text[i] not in self.p:
            yield i + 1, math.prod(self.bytes_[b] for b in text[i].encode())
            return
        for j in range(i + 1, i + 1 + self.automaton.longest_prefix(text[i : i + self.longest])):
            p = self.p.get(text[i:j])
            if p:
                yield j, p

    def log10(self, word: str) -> float:
        text = pieces.SPACE + word
        n = len(text)
        if n <= LINEAR:
            mass = [0.0] * (n + 1)
            mass[0] = 1.0
            get, longest_prefix, longest = self.p.get, self.automaton.longest_prefix, self.longest
            for i in range(n):
                here = mass[i]
                size = longest_prefix(text[i : i + longest])
                if not size or text[i] not in self.p:
                    mass[i + 1] += here * math.prod(self.bytes_[b] for b in text[i].encode())
                    continue
                for j in range(i + 1, i + 1 + size):
                    p = get(text[i:j])
                    if p:
                        mass[j] += here * p
            if mass[n] > 0:
                return math.log10(mass[n])
        logs = [-math.inf] * (n + 1)
        logs[0] = 0.0
        for i in range(n):
            for j, p in self._arcs(text, i):
                a, b = logs[j], logs[i] + math.log(p)
                logs[j] = b if a == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))
        return logs[n] / math.log(10)


@cache
def _lattice(model: str, probabilities: bytes) -> Lattice:
    return Lattice(model, np.frombuffer(probabilities))


def mixed(c: int, n: int, share: float, lattice_log10: float) -> float:
    """log10 of share * c / n + (1 - share) * 10 ** lattice_log10, without underflow."""
    seen = math.log10(share * c / n) if share and c else -math.inf
    unseen = math.log10(1 - share) + lattice_log10 if share < 1 else -math.inf
    high, low = max(seen, unseen), min(seen, unseen)
    return high + math.log10(1 + 10 ** (low - high)) if low > -math.inf else high


def score(documents: DataFrame, model: str = pieces.MODEL, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text", (remainder("doc_id", DIVISOR) == HELD_OUT).alias("held_out"))
    words = stored(counted(documents), "words")
    n_train = documents.filter(~F.col("held_out")).count()
    sums = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = (sums.n or 0) + n_train, sums.v + (n_train > 0)
    share = n / (n + v) if n else 0.0
    counts = piece_counts(words, model)
    smoothed = (counts + 0.5) / (counts.sum() + 0.5 * len(counts) + n_train + 0.5)
    probabilities = spark.sparkContext.broadcast(smoothed.tobytes())
    p_end = (n_train + 0.5) / (counts.sum() + 0.5 * len(counts) + n_train + 0.5)

    def base_term(c: int) -> float:
        return math.log10((c + 0.5) / (n + 0.5 * (v + 1)))

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        log10 = _lattice(model, probabilities.value).log10
        for batch in batches:
            yield {
                "word": batch["word"],
                "c": batch["c"],
                "total": batch["total"],
                "model": [mixed(c, n, share, log10(word.decode())) for word, c in zip(batch["word"], batch["c"], strict=True)],
            }

    scored = stored(map_rows(words, work, "word binary, c long, total long, model double"), "word-scores")
    top = scored.filter(F.length("word") <= HOT_BYTES).orderBy(F.desc("total"), "word").limit(hot).collect()
    table = spark.sparkContext.broadcast(
        (
            {bytes(row.word): i for i, row in enumerate(top)},
            np.array([base_term(row.c) for row in top] + [0.0]),
            np.array([row.model for row in top] + [0.0]),
            np.array([row.c > 0 for row in top] + [False]),
        )
    )
    end_base, end_model = base_term(n_train), mixed(n_train, n, share, math.log10(p_end))

    def of_documents(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        index, base, model_, known = table.value
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "rest")}
            for text in batch["text"]:
                found = lower_words(text)
                at = list(map(index.get, found, repeat(-1)))
                rest = Counter([word for word, i in zip(found, at, strict=True) if i < 0])
                at = np.array(at, dtype=np.int64)
                out["n_tokens"].append(len(found) + 1)
                out["n_known"].append(int(known[at].sum()) + (n_train > 0))
                out["base_score"].append(float(base[at].sum()) + end_base)
                out["score"].append(float(model_[at].sum()) + end_model)
                out["rest"].append([{"word": word, "tf": tf} for word, tf in rest.items()])
            yield {k: batch[k] for k in ("row", "doc_id", "held_out")} | out

    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    partial = stored(
        map_rows(
            rows,
            of_documents,
            "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
            "rest array<struct<word: binary, tf: int>>",
        ),
        "document-scores",
    )
    term = F.log10((F.col("c") + 0.5) / (n + 0.5 * (v + 1)))
    rest = (
        partial.select("row", F.explode("rest").alias("r"))
        .select("row", "r.word", "r.tf")
        .join(scored.select("word", "c", "model"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rest_known"),
            F.sum(F.col("tf") * term).alias("rest_base"),
            F.sum(F.col("tf") * F.col("model")).alias("rest_score"),
        )
    )
    zero = F.lit(0)
    return partial.drop("rest").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", zero)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rest_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", zero)).alias("score"),
    )
