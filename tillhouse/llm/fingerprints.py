"""Similarity digests of documents from their improbable features.

Every window of WINDOW bytes has an entropy, in LEVELS steps. How often a level occurs in all texts ranks it: the rarer
the more telling. Of every RANGE consecutive windows the rarest (leftmost of equals) gets a vote, and windows with POPULAR votes
or more are the text's features. At both ends of a text fewer windows stand for a whole range, so that short texts have
features, too. Features go into a chain of Bloom filters of BITS bits, HASHES bits each, and FEATURES of them to a filter,
in the order of the text. Two digests are compared filter by filter: bits in common, above what chance gives, as a share
of what there could be; each filter of the shorter chain counts with its best partner, by its bits.

All of it is whole numbers up to the comparison, so equal texts have equal digests wherever they are computed with the same ranks.

The edited text of a document needs the next one by descending id. Documents go once through a shuffle into ranges of ids
that are known beforehand, and the first document of each range also to the range before it (that of the first range to the
last one), where it closes the gap. So each range is one pass over sorted rows that holds one document at a time.

Defined results: a NULL text is the empty text; it has no features, and is like other empty texts (1) and unlike all others (0).
A text shorter than a window, or with nothing but uniform windows, has itself as its only feature. NULL ids come last; rows of
one id go by the digest of their text, and equal rows follow each other, in one task, where they are digested once. Texts are
read whole, in slices. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tillhouse.llm.common import gathered, map_rows, stored, text_hash

WINDOW, RANGE, POPULAR = 64, 64, 16
LEVELS, WEAK = 1000, 100
BITS, HASHES, FEATURES = 2048, 5, 160
#: Bits in common count when they are this many deviations above what chance gives.
DEVIATIONS = 4
#: Starts looked at together, and bytes of texts digested together.
SLICE, BLOCK = 1 << 17, 1 << 20
#: Ids per range and in all from which the ranges are taken; this has no influence on results.
SAMPLED, MOST_SAMPLED = 32, 200_000
#: Bytes of texts in a range.
RANGE_BYTES = 24 << 20

_UNIT = 1 << 20
#: c * log2(c) of a byte that occurs c times in a window; the sum is WINDOW * (log2(WINDOW) - entropy).
_WEIGHTS = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], dtype=np.int64)
_STEPS = np.diff(_WEIGHTS)
_FULL = int(_WEIGHTS[WINDOW])
_NONE = np.int64(1 << 62)


def levels(data: np.ndarray) -> np.ndarray:
    """The entropy, from 0 to LEVELS, of every window."""
    n = len(data) - WINDOW
    before, after = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for far in range(1, WINDOW):
        same = (data[far:] == data[:-far]).view(np.uint8)
        before[far:] += same
        after[:-far] += same
    sums = np.empty(n + 1, dtype=np.int64)
    sums[0] = _WEIGHTS[np.bincount(data[:WINDOW])].sum()
    # one byte leaves the window, one comes in
    np.cumsum(_STEPS[before[WINDOW:]] - _STEPS[after[:n]], out=sums[1:])
    sums[1:] += sums[0]
    return ((_FULL - sums) * LEVELS // _FULL).astype(np.int16)


def _joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one, which starts are windows within a text, where each text ends."""
    data = np.frombuffer(b"".join(raws), dtype=np.uint8)
    ends = np.cumsum([len(raw) for raw in raws], dtype=np.int64)
    within = np.ones(len(data), dtype=bool)
    for raw, end in zip(raws, ends.tolist(), strict=True):
        within[max(end - len(raw), end - WINDOW + 1) : end] = False
    return data, within, ends


def _sliced(size: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, from, to): starts of a slice, and with all that share a range with them."""
    for first in range(0, size - WINDOW + 1, SLICE):
        last = min(first + SLICE, size - WINDOW + 1)
        yield first, last, max(0, first - RANGE + 1), min(last + RANGE - 1, size - WINDOW + 1)


def occurrences(raws: list[bytes]) -> np.ndarray:
    """How many windows have each level."""
    data, within, _ = _joined(raws)
    found = np.zeros(LEVELS + 1, dtype=np.int64)
    for first, last, _, _ in _sliced(len(data)):
        found += np.bincount(levels(data[first : last + WINDOW - 1])[within[first:last]], minlength=LEVELS + 1)
    return found


def ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each level: the rarest first, of equally rare ones the lower; those that say too little have none."""
    order = np.lexsort((np.arange(LEVELS + 1), counts))
    found = np.empty(LEVELS + 1, dtype=np.int64)
    found[order] = np.arange(LEVELS + 1)
    found[:WEAK] = -1
    return found


def selected(data: np.ndarray, within: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Starts of all features, ascending."""
    out = [np.zeros(0, dtype=np.int64)]
    for first, last, low, high in _sliced(len(data)):
        rank = table[levels(data[low : high + WINDOW - 1])]
        keys = np.where(within[low:high] & (rank >= 0), rank * (1 << 32) + np.arange(high - low), _NONE)
        # ranges begin before the first start and end behind the last one
        n = len(keys) + 2 * (RANGE - 1)
        padded = np.full(-(-n // RANGE) * RANGE, _NONE)
        padded[RANGE - 1 : RANGE - 1 + len(keys)] = keys
        blocks = padded.reshape(-1, RANGE)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        lowest = np.minimum(behind[: n - RANGE + 1], ahead[RANGE - 1 : n])
        cuts = np.flatnonzero(np.diff(lowest)) + 1
        begins = np.concatenate([[0], cuts])
        votes = np.diff(np.concatenate([begins, [len(lowest)]]))
        chosen = lowest[begins]
        chosen = (chosen[(votes >= POPULAR) & (chosen != _NONE)] & np.int64(0xFFFFFFFF)) + low
        out.append(chosen[(chosen >= first) & (chosen < last)])
    return np.concatenate(out)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return values ^ (values >> np.uint64(28))


def hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits of each feature's bytes."""
    parts = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[starts].view("<u8") if len(starts) else np.zeros((0, WINDOW // 8), dtype=np.uint64)
    found = np.full(len(starts), np.uint64(0x2545F4914F6CDD1D))
    for part in parts.T:
        found = _mixed((found ^ part) * np.uint64(0xD6E8FEB86659FD93))
    return found


def digests(raws: list[bytes], table: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Number of features and filters (rows of 64-bit words) of each text."""
    data, within, ends = _joined(raws)
    starts = selected(data, within, table)
    own, features = np.searchsorted(ends, starts, side="right"), hashes(data, starts)
    seen = np.zeros(len(raws), dtype=bool)
    seen[own] = True
    lone = [i for i, raw in enumerate(raws) if raw and not seen[i]]
    own = np.concatenate([own, np.array(lone, dtype=np.int64)])
    features = np.concatenate([features, np.array([xxh3_64_intdigest(raws[i]) for i in lone], dtype=np.uint64)])

    # a feature counts where its text has it first
    order = np.lexsort((np.arange(len(own)), features, own))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (own[order][1:] != own[order][:-1]) | (features[order][1:] != features[order][:-1])
    kept = np.sort(order[new])
    kept = kept[np.argsort(own[kept], kind="stable")]
    own, features = own[kept], features[kept]
    n = np.bincount(own, minlength=len(raws))
    filters = -(-n // FEATURES)
    at = np.arange(len(own)) - (np.cumsum(n) - n)[own]
    row = (np.cumsum(filters) - filters)[own] + at // FEATURES
    bits = np.zeros((int(filters.sum()), BITS), dtype=np.uint8)
    for i in range(HASHES):
        bits[row, ((features >> np.uint64(i * 11)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    words = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return [(int(k), part) for k, part in zip(n, np.split(words, np.cumsum(filters)[:-1]), strict=True)]


def written(digest: tuple[int, np.ndarray]) -> str:
    """number of features, colon, filters in base64."""
    return f"{digest[0]}:{base64.b64encode(digest[1].tobytes()).decode()}"


def read(text: str) -> tuple[int, np.ndarray]:
    n, filters = text.split(":")
    return int(n), np.frombuffer(base64.b64decode(filters), dtype="<u8").reshape(-1, BITS // 64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1 of two chains of filters, in either order; 1 if they are equal."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    few, many = sorted((a, b), key=lambda x: (len(x), int(np.bitwise_count(x).sum()), x.tobytes()))
    sizes = np.bitwise_count(many).sum(axis=1, dtype=np.int64)
    total = weight = 0.0
    for own in few:
        size = int(np.bitwise_count(own).sum())
        common = np.bitwise_count(own & many).sum(axis=1, dtype=np.int64)
        chance = size * sizes / BITS
        spread = np.sqrt(chance * (1 - size / BITS) * (1 - sizes / BITS))
        most = np.minimum(size, sizes)
        share = np.where(common > chance + DEVIATIONS * spread, (common - chance) / np.maximum(most - chance, 1e-9), 0.0)
        total += size * float(share.max())
        weight += size
    return min(1.0, total / weight)


def _raw(text: str | None) -> bytes:
    return (text or "").encode()


def windows(documents: DataFrame) -> np.ndarray:
    """How many windows of all texts have each level."""

    def packed(counts: np.ndarray) -> dict[str, list]:
        return {"counts": [counts.tobytes()]}

    def count(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        found = np.zeros(LEVELS + 1, dtype=np.int64)
        for batch in batches:
            for raws in _blocks([_raw(text) for text in batch["text"]]):
                found += occurrences(raws)
        yield packed(found)

    def merge(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        found = np.zeros(LEVELS + 1, dtype=np.int64)
        for batch in batches:
            for counts in batch["counts"]:
                found += np.frombuffer(counts, dtype=np.int64)
        yield packed(found)

    rows = gathered(map_rows(documents.select("text").filter("text is not null"), count, "counts binary"), merge, "counts binary")
    return sum((np.frombuffer(row.counts, dtype=np.int64) for row in rows), np.zeros(LEVELS + 1, dtype=np.int64))


def rarity(documents: DataFrame) -> np.ndarray:
    """Ranks of the levels from all windows of all texts."""
    return ranks(windows(documents))


def _blocks(raws: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in order, about BLOCK bytes at a time."""
    held: list[bytes] = []
    size = 0
    for raw in raws:
        held.append(raw)
        size += len(raw)
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _all_digests(texts: list[str | None], table: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Of each text; one that equals the text before is not digested again."""
    new = [not i or text != texts[i - 1] for i, text in enumerate(texts)]
    raws = [_raw(text) for text, first in zip(texts, new, strict=True) if first]
    found = [digest for block in _blocks(raws) for digest in digests(block, table)]
    return [found[i - 1] for i in np.cumsum(new).tolist()]


def fingerprint(documents: DataFrame, table: np.ndarray) -> DataFrame:
    """doc_id, n_features, fingerprint of every document, without a shuffle."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = _all_digests(batch["text"], table)
            yield {"doc_id": batch["doc_id"], "n_features": [n for n, _ in found], "fingerprint": [written(d) for d in found]}

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, n_features long, fingerprint string")


def _place() -> Column:
    """25 bytes that sort like descending ids, NULL last, then the digest of the text."""
    number = F.bitwise_not(F.col("doc_id").cast("long")).bitwiseXOR(F.lit(-(1 << 63)))
    return F.concat(
        F.when(F.col("doc_id").isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))),
        F.unhex(F.lpad(F.coalesce(F.hex(number), F.lit("")), 16, "0")),
        F.coalesce(text_hash(), F.unhex(F.lit("00" * 16))),
    )


def ranges(places: DataFrame, parts: int) -> tuple[list[bytes], dict[bytes, int]]:
    """Where ranges begin, and which range needs to see the first document of which other one."""
    sample = places.orderBy(F.rand(11)).limit(min(SAMPLED * parts, MOST_SAMPLED)).collect()
    sample = sorted(bytes(row.place) for row in sample)
    cuts = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []

    def first(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        found: dict[int, bytes] = {}
        for batch in batches:
            for place in batch["place"]:
                own = bisect_right(cuts, place)
                if own not in found or place < found[own]:
                    found[own] = place
        yield {"range": list(found), "place": list(found.values())}

    rows = map_rows(places, first, "range long, place binary").groupBy("range").agg(F.min("place").alias("place"))
    firsts = sorted((row.range, bytes(row.place)) for row in rows.collect())  # a row for each range
    return cuts, {place: firsts[i - 1][0] for i, (_, place) in enumerate(firsts)}


def in_order(documents: DataFrame, size: int) -> DataFrame:
    """range, role, place, doc_id, text, sorted; role 1 is the document after the range's last one. size: bytes of all texts."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _place().alias("place"))
    parts = max(1, -(-size // RANGE_BYTES), documents.rdd.getNumPartitions())
    cuts, ahead = ranges(stored(rows.select("place"), "places"), parts)

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        sent: set[bytes] = set()
        for batch in batches:
            out = batch | {"range": [bisect_right(cuts, place) for place in batch["place"]], "role": [0] * len(batch["place"])}
            for i, place in enumerate(batch["place"]):
                if place in ahead and place not in sent:
                    sent.add(place)
                    for column in ("doc_id", "text", "place"):
                        out[column].append(out[column][i])
                    out["range"].append(ahead[place])
                    out["role"].append(1)
            yield out

    dealt = map_rows(rows, work, "range long, role int, place binary, doc_id long, text string")
    order = ["range", "role", "place"]
    # each range is a partition: by a hash of their numbers several of them would meet in one
    return dealt.repartitionById(len(cuts) + 1, F.col("range").cast("int")).sortWithinPartitions(*order)


def edited(text: str, following: str) -> str:
    """The second half replaced by the beginning of the other text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_features long"


def compare_edits(documents: DataFrame) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how like they are to each other and to the next one."""
    counts = windows(documents)
    table = ranks(counts)

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        names = [part.split()[0] for part in RESULT.split(", ")]
        last: tuple | None = None  # range, doc_id, text, digest of the document whose next one is not there yet
        done: tuple | None = None  # texts and results of the pair before
        for batch in batches:
            rows = list(zip(batch["range"], batch["role"], batch["doc_id"], batch["text"], strict=True))
            own = _all_digests(batch["text"], table)
            pairs = []
            for (range_, role, doc_id, text), digest in zip(rows, own, strict=True):
                if last and last[0] == range_:
                    pairs.append((last[1:], (text, digest)))
                last = None if role else (range_, doc_id, text, digest)
            changed = [edited(text, following) for (_, text, _), (following, _) in pairs]
            found = _all_digests(changed, table)
            out: dict[str, list] = {name: [] for name in names}
            for ((doc_id, text, digest), (following, after)), change, other in zip(pairs, changed, found, strict=True):
                if done is None or done[0] != (text, following):
                    values = (hashlib.sha256(_raw(change)).hexdigest(), written(digest), written(other))
                    done = (text, following), (len(text), *values, likeness(digest[1], other[1]), likeness(digest[1], after[1]), digest[0])
                for name, value in zip(names, (doc_id, *done[1]), strict=True):
                    out[name].append(value)
            yield out

    rows = in_order(documents, int(counts.sum()))
    return map_rows(rows.select("range", "role", "doc_id", "text"), work, RESULT)
