"""Line quality: a linear-chain conditional random field marks each line as content or boilerplate.

The field has two states. Its emission weights act on a few ratios of the line's characters and words, its
transition weights on neighbouring lines. It is fitted on a bounded sample of labelled documents by gradient ascent on
the exact log-likelihood, from the forward-backward recursion. A line takes its document's label, and stretches of good
and bad documents take turns in a training sequence, so that the field learns how long a state lasts and what a change
looks like. Viterbi decoding then labels all lines of a document, and the share of its words that lie in
content lines decides whether it is kept.

Defined results: NULL and empty texts have no words, zero counts and are not kept (too few words). Lines of a
document are read whole, however many there are. Rows that repeat are judged one by one. Without labels of both
kinds there is no field, and only the counted rules decide. Of labelled rows that repeat an id one is used for fitting,
that with the smallest lines; labels without a document, and rows without an id, are not. Columns other than id and text
are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import SEPARATORS, map_rows

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
PUNCTUATION = b".,;:!?"
FEATURES = 11

#: Labelled documents of each kind used for fitting, stretches of each, spread over the whole text, and lines in a stretch.
SAMPLE_DOCUMENTS = 600
STRETCHES, SAMPLE_LINES = 4, 16
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5

CONTENT, BOILERPLATE = 0, 1


class Field(NamedTuple):
    """Log-potentials: emission[state] times features, transition[from, to], start[state]."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray


def line_features(line: bytes) -> tuple[list[float], int]:
    """The features of one line and its number of words."""
    found = line.split()
    n_words, n = len(found), len(line) or 1

    def share(characters: bytes) -> float:
        return (len(line) - len(line.translate(None, characters))) / n

    upper, lower = share(UPPER), share(LOWER)
    distinct = len(set(found)) / n_words if n_words else 1.0
    return [
        1.0,
        upper / (upper + lower) if upper + lower else 0.0,
        min(1.0, 8 * share(SYMBOLS)),
        share(DIGITS),
        min(1.0, 4 * share(PUNCTUATION)),
        min(1.0, 8 * share(b"!")),
        1.0 - distinct,
        1.0 if n_words > 12 and distinct < 0.5 else 0.0,
        min(1.0, line.count(b"|") / (n_words or 1) * 4),
        min(1.0, math.log1p(n_words) / 6),
        0.0 if n_words else 1.0,
    ], n_words


def viterbi(features: np.ndarray, field: Field) -> np.ndarray:
    """The most probable state of every line; ties go to content."""
    scores = features @ field.emission.T
    (aa, ab), (ba, bb) = field.transition.tolist()
    a, b = (scores[0] + field.start).tolist()
    back = []
    for x, y in scores[1:].tolist():
        from_a = a + aa >= b + ba, a + ab >= b + bb
        back.append(from_a)
        a, b = (a + aa if from_a[0] else b + ba) + x, (a + ab if from_a[1] else b + bb) + y
    state = CONTENT if a >= b else BOILERPLATE
    states = [state]
    for from_a in reversed(back):
        state = CONTENT if from_a[state] else BOILERPLATE
        states.append(state)
    return np.array(states[::-1])


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 150, rate: float = 1.0, ridge: float = 1e-3) -> Field | None:
    """Gradient ascent on the mean log-likelihood of the label paths: features of the lines of a sequence, and their states."""
    sequences = [(x, y) for x, y in sequences if len(x)]
    if len({state for _, y in sequences for state in y}) < 2:
        return None
    longest = max(len(x) for x, _ in sequences)
    n = len(sequences)
    lengths = np.array([len(x) for x, _ in sequences])
    x, truth = np.zeros((n, longest, FEATURES)), np.zeros((n, longest, 2))
    for i, (rows, states) in enumerate(sequences):
        x[i, : len(rows)] = rows
        truth[i, np.arange(len(rows)), states] = 1
    live = np.arange(longest)[None, :] < lengths[:, None]
    weight = 1.0 / lengths.sum()
    emission, transition, start = np.zeros((2, FEATURES)), np.zeros((2, 2)), np.zeros(2)
    seen_emission = np.einsum("nts,ntf->sf", truth, x)
    seen_transition = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
    seen_start = truth[:, 0].sum(0)
    for _ in range(steps):
        scores = x @ emission.T
        forward = np.empty((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + transition, axis=1) + scores[:, t]
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(transition + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        marginal = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        pair = np.exp(
            forward[:, :-1, :, None] + transition + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        pair = (pair * live[:, 1:, None, None]).sum((0, 1))
        emission += rate * (weight * (seen_emission - np.einsum("nts,ntf->sf", marginal, x)) * 4 - ridge * emission)
        transition += rate * (weight * (seen_transition - pair) * 4 - ridge * transition)
        start += rate * (weight * (seen_start - marginal[:, 0].sum(0)) * 4 - ridge * start)
    return Field(emission, transition, start)


def stretches(text: str | None) -> list[np.ndarray]:
    """Features of the lines of a text: of all, or of STRETCHES runs of SAMPLE_LINES, the first and the last among them."""
    lines = (text or "").encode().split(b"\n")
    runs = -(-len(lines) // SAMPLE_LINES)
    chosen = range(runs) if runs <= STRETCHES else np.linspace(0, runs - 1, STRETCHES).round().astype(int)
    parts = [lines[k * SAMPLE_LINES : (k + 1) * SAMPLE_LINES] for k in chosen]
    return [np.array([line_features(line)[0] for line in part], dtype="<f8") for part in parts]


def taking_turns(good: list[list[np.ndarray]], bad: list[list[np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences: the stretches of a good and of a bad document in turn, either first; of the fewer, some again."""
    out = []
    for i in range(max(len(good), len(bad)) if good and bad else 0):
        pair = [(part, state) for state, docs in ((CONTENT, good), (BOILERPLATE, bad)) for part in docs[i % len(docs)]]
        turns = [[part for part, state in pair if state == own] for own in (CONTENT, BOILERPLATE)]
        sequence = []
        for k in range(max(map(len, turns))):
            for own in (i % 2, 1 - i % 2):
                if k < len(turns[own]):
                    sequence.append((turns[own][k], own))
        states = np.concatenate([np.full(len(part), own) for part, own in sequence])
        out.append((np.concatenate([part for part, _ in sequence]), states))
    return out


def train(documents: DataFrame, labels: DataFrame, n: int = SAMPLE_DOCUMENTS) -> Field | None:
    """Fit on n labelled documents of each kind, those with the smallest hash of their id.

    The sample is the only part that meets in one place: 2 n documents of STRETCHES * SAMPLE_LINES lines at most, whatever
    number of rows has their ids.
    """
    chosen = None
    for kind in (0, 1):
        own = labels.filter((F.col("quality") == kind) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
        own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id", F.lit(1 - kind).alias("label"))
        chosen = own if chosen is None else chosen.unionByName(own)
    wanted = {row.doc_id: row.label for row in chosen.collect()}

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            hits = [(i, d) for i, d in enumerate(batch["doc_id"]) if d in wanted]
            parts = [stretches(batch["text"][i]) for i, _ in hits]
            yield {
                "doc_id": [d for _, d in hits],
                "lines": [np.concatenate(part).tobytes() for part in parts],
                "sizes": [[len(p) for p in part] for part in parts],
            }

    if not wanted:
        return None
    texts = documents.filter(F.col("text").isNotNull() & F.col("doc_id").isin(list(wanted))).select("doc_id", "text")
    found = map_rows(texts, work, "doc_id long, lines binary, sizes array<int>")
    rows = found.groupBy("doc_id").agg(F.min(F.struct("lines", "sizes")).alias("one")).select("doc_id", "one.*").collect()
    rows.sort(key=lambda row: bytes(row.lines))
    kinds: tuple[list, list] = ([], [])
    for row in rows:
        lines = np.frombuffer(row.lines, dtype="<f8").reshape(-1, FEATURES)
        kinds[wanted[row.doc_id]].append(np.split(lines, np.cumsum(row.sizes)[:-1]))
    return fit(taking_turns(*kinds))


def repeated_words(found: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text, first occurrences included."""
    if len(found) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in found], dtype=np.int64)
    base = len(number)
    if base < 2_000_000:
        windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        hot = counts[inverse] > 1
    else:
        triples = list(zip(ids[:-2].tolist(), ids[1:-1].tolist(), ids[2:].tolist(), strict=True))
        seen = Counter(triples)
        hot = np.array([seen[triple] > 1 for triple in triples])
    covered = np.zeros(len(found), dtype=bool)
    covered[:-2] |= hot
    covered[1:-1] |= hot
    covered[2:] |= hot
    return int(covered.sum())


def judge(text: str | None, field: Field | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    text = text or ""
    raw = text.encode()
    found = raw.split()
    n_words = len(found)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, SEPARATORS)))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    n_repeat = repeated_words(found)
    seen: set[bytes] = set()
    features, per_line, n_dup = [], [], 0
    for line in raw.split(b"\n"):
        row, n = line_features(line)
        features.append(row)
        per_line.append(n)
        if n:
            n_dup += line in seen
            seen.add(line)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    share = 1.0 if n_words else 0.0
    if field is not None and n_words:
        states = viterbi(np.array(features), field)
        share = float(np.array(per_line)[states == CONTENT].sum()) / n_words
    return n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, share, not base_failed and share >= MIN_CONTENT_SHARE


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept")
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


def assess(documents: DataFrame, field: Field | None) -> DataFrame:
    """Counts and verdict of every document; one pass, no shuffle."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows = [judge(text, field) for text in batch["text"]]
            yield {"doc_id": batch["doc_id"]} | {name: [row[i] for row in rows] for i, name in enumerate(COLUMNS)}

    return map_rows(documents.select("doc_id", "text"), work, SCHEMA)


def keep_good(documents: DataFrame, field: Field | None) -> DataFrame:
    """The documents that are kept, with all their columns, whatever these are called; repeated rows are judged alike.

    NULL and empty texts have too few words and go. An empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(text, field)[-1] for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
