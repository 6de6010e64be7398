"""Removal of every byte covered by a string of `length` bytes that also starts anywhere else.

Sorting all suffixes by a difference cover modulo 3 would move a row for two of three bytes of the corpus, several
times. Only equality of prefixes of one fixed length is asked here, so the cover is taken from the content
instead: of the `length - GRAM + 1` grams in a window, the one with the smallest hash (leftmost of equals) is its
sample. Equal windows have their sample at the same offset, and neighbouring windows share it, so one row
stands for a run of about a hundred starts. The steps are those of the difference-cover algorithm on that sample:

1. Sampled positions are named by the hash of their gram; only names that occur twice go on.
2. The text around a sample that its run of windows covers is its context, named in turn. Equal contexts settle
   their whole run. This is the common case: all of a repeated passage but its two ends.
3. The rest, one of each context under a name that has several, is merged with the others of its name window by
   window: what is equal at the same offset starts elsewhere, too.
4. Names with very many different contexts are not merged in one task: their windows are named one by one, and the
   names counted in Spark.

Runs are turned into byte intervals, these are united per text. Documents with the same text are one text that
starts elsewhere as a whole. A hash of a window has 128 bits together with the name it is compared under.

Defined results: a NULL text is the empty text. Texts shorter than `length` lose nothing. Repeated rows and rows
with the same or no id are copies of each other if their texts are equal. Texts of any length are searched whole, in slices. An empty table
gives no rows. Columns other than id and text take no part, whatever their names; `strip` keeps them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillhouse.llm.common import Scratch, gathered, map_rows, stored, text_hash

LENGTH = 400
#: Shorter than any passage of more than 50 words: what the pipeline removes, and what the removal counts beside its own rule.
PASSAGE = 250
#: Bits of the filter of texts with long repeats, and how many of them a text sets.
FILTER_BITS, FILTER_HASHES = 1 << 25, 5
#: Bytes of a gram, as a share of the length; longer grams repeat less often by chance, shorter ones give fewer samples.
GRAM_SHARE = 0.4
#: Starts of one text looked at together, bytes of short texts hashed together, and contexts merged together.
SLICE = 1 << 21
CHUNK = 1 << 17
MERGED = 2048
#: Names with more contexts are merged in Spark.
MOST_CONTEXTS = 4096

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(32))


@cache
def _letters(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _powers(inverse: bool, size: int) -> np.ndarray:
    powers = np.full(size, _INVERSE if inverse else _BASE, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class Sums:
    """Hashes of any substrings of a text, from running sums."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        size = 1 << max(16, len(data).bit_length())
        self.inverse = _powers(True, size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_letters(seed)[data] * _powers(False, size)[: len(data)], out=self.sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """Of all substrings of this width."""
        n = len(self.sums) - width
        return _mixed((self.sums[width:] - self.sums[:n]) * self.inverse[:n])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours."""
    n, least, done = len(keys) - width + 1, keys, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    return np.minimum(least[:n], least[width - done : width - done + n])


def samples(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """name, context, position, first and last start of every run of windows with the same sample, and the number of its text.

    data: one slice, or several texts of `length` bytes at least, one after the other; starts: where these begin. Places count
    from the start of the text.
    """
    sums = Sums(data)
    grams = sums.windows(gram)
    places = np.uint64(SLICE * 2 - 1)
    at = (_least(grams & ~places | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & places).astype(np.int64)
    # a run ends with its text; the windows after it, up to the next text, would hold bytes of both
    over = np.append(starts[1:], len(data)) - length + 1
    edges = np.unique(np.concatenate([starts, over, np.flatnonzero(at[1:] != at[:-1]) + 1]))
    first, last = edges[:-1], edges[1:] - 1
    text = np.searchsorted(starts, first, side="right") - 1
    inside = first < over[text]
    first, last, text = first[inside], last[inside], text[inside]
    position, base = at[first], starts[text]
    context = sums.between(first, last + length) + _mixed((position - first).astype(np.uint64) + np.uint64(7))
    return grams[position].view(np.int64), context.view(np.int64), position - base, first - base, last - base, text


def _chunks(offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, int, int, int]]:
    """Rows, first and last byte, and where in its text the first byte is: short texts together, longer ones in slices.

    offsets: where each row's bytes begin, and the end of the last.
    """
    row = 0
    while row < len(offsets) - 1:
        begin = int(offsets[row])
        more = max(row + 1, int(np.searchsorted(offsets, begin + min(CHUNK, SLICE), side="right")) - 1)
        size = int(offsets[more]) - begin
        if more > row + 1 or size < SLICE + length:
            yield np.arange(row, more), begin, begin + size, 0
        else:
            for start in range(0, size - length + 1, SLICE):
                yield np.arange(row, more), begin + start, begin + min(size, start + SLICE + length - 1), start
        row = more


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a column of texts or bytes without NULL, and where each row's begin and the last ends."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data and offsets[-1] else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _samples_of(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per run of windows: name, context, text hash, position, first and last start."""

    schema = pa.schema([("name", pa.int64()), ("context", pa.int64()), ("h", pa.binary()), ("position", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _bytes_of(batch.column("text"))
            for rows, begin, end, start in _chunks(offsets, length):
                name, context, position, first, last, text = samples(data[begin:end], offsets[rows] - (begin - start), length, gram)
                hashes = batch.column("h").take(pa.array(rows[text]))
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(context), hashes, *(pa.array(p + start) for p in (position, first, last))], schema=schema)

    texts = documents.filter(F.octet_length("text") >= length).select("text", text_hash().alias("h"))
    return texts.mapInArrow(run, "name long, context long, h binary, position long, first long, last long")


def merged_starts(rows: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """name, context, a, b: starts from -a to -b before the sample whose windows also are in another context.

    rows: name, context, whether it occurs several times, bytes before the sample at its first start, its bytes; all different.
    All contexts of a name must be among them.
    """
    name, context, many, before = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("name", "context", "many", "before"))
    data, offsets = _bytes_of(rows.column("data"))
    windows = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(name)), windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = offsets[row] + nth
    ahead = before[row] - nth
    keys = Sums(data, 2).between(start, start + length) + ahead.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    _, inverse, counts = np.unique(_mixed(keys) ^ name[row].view(np.uint64), return_inverse=True, return_counts=True)
    found = (counts[inverse] > 1) & ~many[row]
    first = np.flatnonzero(found & np.append(True, ~found[:-1] | (row[1:] != row[:-1])))
    last = np.flatnonzero(found & np.append(~found[1:] | (row[1:] != row[:-1]), True))
    return name[row[first]], context[row[first]], ahead[first], ahead[last]


def _merge(contexts: DataFrame, length: int) -> DataFrame:
    """Names with few contexts: whole names at a time, in the order of names."""

    def out(rows: pa.RecordBatch) -> pa.RecordBatch:
        name, context = (rows.column(c).to_numpy() for c in ("name", "context"))
        rows = rows.filter(pa.array(np.append(True, (name[1:] != name[:-1]) | (context[1:] != context[:-1]))))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in merged_starts(rows, length)], names=["name", "context", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= MERGED:
                rows = pa.concat_batches(held)
                name = rows.column("name").to_numpy()
                cut = int(np.searchsorted(name, name[-1]))
                if cut:
                    yield out(rows.slice(0, cut))
                held = [rows.slice(cut)]
        if held and (rows := pa.concat_batches(held)).num_rows:
            yield out(rows)

    ordered = contexts.repartition("name").sortWithinPartitions("name", "context")
    return ordered.select("name", "context", "many", "before", "data").mapInArrow(run, "name long, context long, a long, b long")


def _merge_windows(contexts: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """Names with very many contexts: every window is a row, counted by its name."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for name, context, many, before, data in zip(*(batch[c] for c in ("name", "context", "many", "before", "data")), strict=True):
                hashes = Sums(np.frombuffer(data, dtype=np.uint8), 2).windows(length)
                n = len(hashes)
                yield {"name": [name] * n, "context": [context] * n, "many": [many] * n, "a": before - np.arange(n), "w": hashes.view(np.int64)}

    contexts = contexts.dropDuplicates(["name", "context"])
    windows = map_rows(contexts.select("name", "context", "many", "before", "data"), work, "name long, context long, many boolean, a long, w long")
    twice = windows.groupBy("name", "a", "w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    twice = scratch.stored(twice, "windows")
    return windows.filter(~F.col("many")).join(twice, ["name", "a", "w"]).select("name", "context", "a", F.col("a").alias("b"))


def covered(documents: DataFrame, length: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Intervals (h, start, end) that repeat, of each different text by its hash; and the hashes of all texts that occur twice.

    Both read tables in scratch.
    """
    gram = max(1, int(length * GRAM_SHARE))

    long = documents.filter(F.octet_length("text") >= length).select("doc_id", text_hash().alias("h"))
    texts = long.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    texts = scratch.stored(texts, "texts")
    copied = texts.filter("copies > 1").select("h")

    found = scratch.stored(_samples_of(documents, length, gram), "samples")
    twice = scratch.stored(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"), "names")
    repeated = scratch.stored(found.join(twice, "name"), "repeated")
    scratch.discard(found, twice)

    # one row per context: how many places have it, one of them. A text that occurs twice has its places twice here, so
    # its contexts occur several times in any case
    groups = repeated.groupBy("name", "context").agg(F.count(F.lit(1)).alias("places"), F.min(F.struct("h", "position", "first", "last")).alias("one"))
    groups = scratch.stored(groups.select("name", "context", (F.col("places") > 1).alias("many"), "one.*"), "contexts")
    settled = groups.filter("many").select("name", "context")
    whole = repeated.join(settled, ["name", "context"]).select("h", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    per_name = groups.groupBy("name").agg(F.count(F.lit(1)).alias("contexts"), F.min("many").alias("done")).filter("contexts > 1 and not done")
    open_ = scratch.stored(groups.join(scratch.stored(per_name.select("name", "contexts"), "open-names"), "name"), "open")
    data = scratch.stored(_data_of(open_, texts, documents, length, scratch), "context-data")
    few = _merge(data.filter(F.col("contexts") <= MOST_CONTEXTS), length)
    many = _merge_windows(data.filter(F.col("contexts") > MOST_CONTEXTS), length, scratch)
    starts = few.unionByName(many).join(open_.select("name", "context", "h", "position"), ["name", "context"])
    parts = starts.select("h", (F.col("position") - F.col("a")).alias("start"), (F.col("position") - F.col("b") + length).alias("end"))
    return whole.unionByName(parts), copied


def _data_of(asked: DataFrame, texts: DataFrame, documents: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """The bytes of each context, from one document that has its text; of repeated rows, possibly from several."""
    places = F.collect_list(F.struct("name", "context", "many", "contexts", "position", "first", "last"))
    wanted = asked.groupBy("h").agg(places.alias("places")).join(texts.select("h", "doc_id"), "h")
    wanted = scratch.stored(wanted.withColumnsRenamed({"doc_id": "asked_id", "h": "asked_h"}), "wanted")
    rows = documents.filter(F.octet_length("text") >= length).select("doc_id", "text", text_hash().alias("h"))
    # a row meets one wanted row at most, whatever ids are repeated or missing; the id only spares other copies of the text
    rows = rows.join(wanted.hint("merge"), (F.col("h") == F.col("asked_h")) & F.col("doc_id").eqNullSafe(F.col("asked_id")))

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        done = None
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("name", "context", "many", "contexts", "before", "data")}
            for text, h, places in zip(batch["text"], batch["h"], batch["places"], strict=True):
                if h == done:  # the join leaves repeated rows next to each other
                    continue
                raw, done = text.encode(), h
                for place in places:
                    for c in ("name", "context", "many", "contexts"):
                        out[c].append(place[c])
                    out["before"].append(place["position"] - place["first"])
                    out["data"].append(raw[place["first"] : place["last"] + length])
            yield out

    return map_rows(rows.select("text", "h", "places"), work, "name long, context long, many boolean, contexts long, before long, data binary")


def united(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching intervals as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _united_by_text(intervals: DataFrame) -> DataFrame:
    """h, spans: the intervals of each text, united in the same way."""
    schema = to_arrow_schema(intervals.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            start, end = (field.to_numpy() for field in spans.flatten().flatten())
            row = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy()) << 32
            order = np.argsort(row + start, kind="stable")
            row, start = row[order], (row + start)[order]
            end = np.maximum.accumulate(row + end[order])  # what another text has lies below
            first = np.append(True, start[1:] > end[:-1])[: len(start)]
            last = np.append(first[1:], True)[: len(start)]
            offsets = np.searchsorted(row[first], np.arange(len(spans) + 1) << 32)
            places = pa.StructArray.from_arrays([pa.array(start[first] - row[first]), pa.array(end[last] - row[last])], ["start", "end"])
            found = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), places)
            yield pa.RecordBatch.from_arrays([batch.column("h"), found.cast(schema.field("spans").type)], schema=schema)

    return intervals.mapInArrow(run, intervals.schema)


def _spans(documents: DataFrame, length: int) -> DataFrame:
    """h, spans (intervals to remove, apart from each other) of texts that lose something; stored, all that led to it is gone."""
    scratch = Scratch()
    intervals, copied = covered(documents, length, scratch)
    spans = intervals.join(copied, "h", "left_anti").groupBy("h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    whole = copied.select("h", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))).alias("spans"))
    found = stored(_united_by_text(spans).unionByName(whole), "spans")
    scratch.discard()
    return found


def _bits(h: bytes) -> list[int]:
    """Bits that a text's hash sets."""
    a, b = int.from_bytes(h[:8], "little"), int.from_bytes(h[8:16], "little") | 1
    return [(a + i * b) % FILTER_BITS for i in range(FILTER_HASHES)]


def _long_repeats(documents: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """doc_id and text of the documents in whose text some run of the spans is that long, and a few others.

    A string of that length repeats only within such a run, in all the texts that have it. Their hashes go into a filter of a
    fixed size, so that the texts need no shuffle; when it is crowded, more of the others come along, which costs time only.
    """

    def packed(bits: np.ndarray) -> dict[str, list]:
        return {"bits": [np.packbits(bits).tobytes()]}

    def mark(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            for h, own in zip(batch["h"], batch["spans"], strict=True):
                if any(s["end"] < 0 or s["end"] - s["start"] >= length for s in own):
                    bits[_bits(h)] = True
        yield packed(bits)

    def merge(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            for part in batch["bits"]:
                bits |= np.unpackbits(np.frombuffer(part, dtype=np.uint8)).view(bool)
        yield packed(bits)

    (row,) = gathered(map_rows(spans, mark, "bits binary"), merge, "bits binary", 1)
    words = documents.sparkSession.sparkContext.broadcast(bytes(row.bits))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(words.value, dtype=np.uint8)
        for batch in batches:
            chosen = [all(known[k >> 3] >> (7 - (k & 7)) & 1 for k in _bits(h)) for h in batch.column("h").to_pylist()]
            yield batch.select(["doc_id", "text"]).filter(pa.array(chosen, type=pa.bool_()))

    texts = documents.filter(F.octet_length("text") >= length).select("doc_id", "text", text_hash().alias("h"))
    return texts.mapInArrow(keep, texts.select("doc_id", "text").schema)


def remove(documents: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and n_repeated.

    n_repeated counts the bytes covered by a string of passage bytes, which is shorter, that also starts elsewhere. These stay;
    they tell documents that share a passage from others. Where they are found first, only texts with a long enough run
    of them can have longer repeats.
    """
    passage = min(passage, length)
    short = _spans(documents, passage)
    scratch, spans = Scratch(), short
    if passage < length:
        spans = _spans(scratch.stored(_long_repeats(documents, short, length), "long-repeats"), length)
        scratch.discard()
    spans = short.withColumnRenamed("spans", "repeated").join(spans, "h", "left")

    rows = documents.select("doc_id", "text", text_hash().alias("h"))
    rows = rows.join(spans.hint("merge"), "h", "left")  # shuffled at every size: the spans grow with the data

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch["doc_id"], **{name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated")}}
            for text, found, repeated in zip(batch["text"], batch["spans"], batch["repeated"], strict=True):
                raw = (text or "").encode()
                kept, gone = cut(raw, found)
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(kept))
                out["n_spans"].append(gone)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["n_repeated"].append(len(raw) - len(cut(raw, repeated)[0]))
            yield out

    return map_rows(rows.select("doc_id", "text", "spans", "repeated"), work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long")


def cut(raw: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of runs removed; an end of -1 is the text's end."""
    if not spans:
        return raw, 0
    gone = united([(s["start"], len(raw) if s["end"] < 0 else s["end"]) for s in spans])
    kept, at = [], 0
    for start, end in gone:
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    return b"".join(kept), len(gone)


def strip(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without the bytes that repeat, with all their columns; n_chars, if there is one, is counted again.

    A character that loses some of its bytes goes as a whole. Documents with nothing left stay, with an empty text.
    """
    spans = _spans(documents, length)
    key = "_text_hash"
    while key in documents.columns:
        key += "_"

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(gone).to_pylist()
            texts = batch.column("text").to_pylist()
            for i, own in enumerate(found):
                if own and texts[i]:
                    texts[i] = cut(texts[i].encode(), own)[0].decode(errors="ignore")
            new = {"text": pa.array(texts, type=batch.schema.field("text").type)}
            if "n_chars" in batch.schema.names:
                old = batch.column("n_chars").to_pylist()
                kind = batch.schema.field("n_chars").type
                new["n_chars"] = pa.array([len(t) if f and t is not None else n for t, f, n in zip(texts, found, old, strict=True)], type=kind)
            names = documents_schema.names
            yield pa.RecordBatch.from_arrays([new.get(name, batch.column(name)) for name in names], names=names)

    documents_schema = documents.schema
    gone = f"{key}_spans"
    rows = documents.withColumn(key, text_hash())
    spans = spans.toDF(key, gone)
    return rows.join(spans.hint("merge"), key, "left").drop(key).mapInArrow(cut_texts, documents_schema)
