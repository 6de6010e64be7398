"""Near duplicates of word shingles, by HyperMinHash sketches and confirmation on full sets.

A document's set is that of its distinct shingles, as 64-bit hashes. Equal sets are one class. A class's sketch has
REGISTERS buckets; each keeps the smallest hash that falls into it, compressed to the number of its leading zeros
and the MANTISSA bits after them. An empty bucket takes the register of a filled one, chosen by a fixed random order,
so that small sets can be compared too. BANDS bands of compressed registers are the keys on which classes meet.

Two classes at a similarity of 0.85 agree in a band of 6 registers with probability 0.377, so the chance that they
meet in none of 40 bands is 6e-9. Pairs that meet are dropped if their estimated similarity, corrected for registers
that agree by chance, is more than five standard deviations below the threshold; all others are confirmed on full sets.

No bucket is expanded into all its pairs. First each class is compared with the smallest class of its buckets;
confirmed links give components. Only where a bucket still has classes of several components are these compared with
each other, in blocks inside the tasks: first register by register, where a pair counts only in its first common
band; what passes the estimate is compared on full sets, and each block hands on no more links than join its
components. So every pair that meets is either confirmed, refuted, or in one component already, and no list of pairs
is ever made.

Defined results: a NULL text and one without words have the empty set, are linked with nothing and kept. Equal sets
are linked. A component's id is its smallest non-null doc_id; a component without one has NULL, and `link` marks all its
rows as kept. `keep_one` decides by row, not by id: of each component exactly one row stays, whatever ids are repeated
or missing. Texts of any length are taken whole, one document's set in a worker at a time. An empty table gives no rows. Columns
other than id and text take no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tillhouse.llm.common import lower_words, map_rows, stored, text_hash
from tillhouse.llm.graph import components

BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Members of a bucket that are compared with each other in one task.
BLOCK = 1024
#: Linked if 100 * intersection >= percent * union.
SHINGLE, PERCENT = 5, 80
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D], dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; the whole sequence if it is shorter, empty without words."""
    found = lower_words(text)
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    used = min(width, len(found))
    total = np.full(len(found) - used + 1, used, dtype=np.uint64)
    for i in range(used):
        total = _mixed(total) + hashes[i : len(found) - used + 1 + i] * _ODD[i % len(_ODD)]
    return np.unique(_mixed(total))


@cache
def _orders() -> np.ndarray:
    """For each bucket, a random order of all buckets."""
    return np.random.default_rng(20).random((REGISTERS, REGISTERS))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The compressed registers of a non-empty set."""
    low = hashes & np.uint64(0xFFFFFFFF)
    bucket = (hashes >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)
    keys = np.sort(bucket << np.uint64(32) | low)
    filled, first = np.unique(keys >> np.uint64(32), return_index=True)
    smallest = (keys[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    bits = np.where(smallest > 0, np.floor(np.log2(np.maximum(smallest, 1))).astype(np.int64) + 1, 0)
    zeros = 32 - bits
    mantissa = np.where(bits > 0, ((smallest << (zeros + 1)) & 0xFFFFFFFF) >> (32 - MANTISSA), 0)
    registers = np.zeros(REGISTERS, dtype="<u2")
    registers[filled.astype(np.int64)] = zeros << MANTISSA | mantissa
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled.astype(np.int64), assume_unique=True)
        source = filled.astype(np.int64)[np.argmin(_orders()[np.ix_(empty, filled.astype(np.int64))], axis=1)]
        registers[empty] = registers[source]
    return registers


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of registers that agree by chance in two unrelated sets of n and m elements.

    The published approximation for sets that fill their buckets: 0.1699 * 2**-r * 4 n m / (n + m)**2.
    """
    n, m = np.asarray(n, dtype=float), np.asarray(m, dtype=float)
    return 0.169919487159739 * 2.0 ** (1 - MANTISSA) * 4 * n * m / (n + m) ** 2


def passes(agree: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether a pair with this share of equal registers may reach the threshold."""
    least = percent / 100
    by_chance = chance(n, m)
    estimate = (agree - by_chance) / (1 - by_chance)
    near = estimate >= least - 5 * math.sqrt(least * (1 - least) / REGISTERS)
    return near & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Keys of the bands of each row of registers."""
    parts = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(registers), BANDS)).copy()
    for i in range(ROWS):
        total = _mixed(total * _ODD[i] + parts[:, :, i] + np.uint64(1))
    return total.view(np.int64)


def _sketches(documents: DataFrame, width: int) -> DataFrame:
    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            sets = [shingles(text, width) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "h": batch["h"],
                "n": [len(s) for s in sets],
                "cls": [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "registers": [sketch(s).tobytes() if len(s) else None for s in sets],
            }

    return map_rows(documents.select("doc_id", "text", text_hash().alias("h")), work, "doc_id long, h binary, n long, cls binary, registers binary")


def _bands(classes: DataFrame) -> DataFrame:
    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            if batch["cls"]:
                keys = band_keys(np.frombuffer(b"".join(batch["registers"]), dtype="<u2").reshape(-1, REGISTERS))
                yield {
                    "key": keys.ravel(),
                    "band": np.tile(np.arange(BANDS, dtype=np.int32), len(keys)),
                    "cls": np.repeat(np.array(batch["cls"], dtype=object), BANDS),
                }

    return map_rows(classes.select("cls", "registers"), work, "key long, band int, cls binary")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the estimate."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            if not batch["a"]:
                continue
            left, right = (np.frombuffer(b"".join(batch[c]), dtype="<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
            good = passes((left == right).mean(1), np.array(batch["na"]), np.array(batch["nb"]), percent)
            yield {c: [x for x, keep in zip(batch[c], good, strict=True) if keep] for c in ("a", "b")}

    side = classes.select("cls", "n", "registers")
    joined = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
    return map_rows(joined, work, "a binary, b binary")


def _sets(asked: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """cls, hashes: the full sets of the classes asked for, from one text of each."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {"cls": [], "hashes": []}
            for text, cls in zip(batch["text"], batch["cls"], strict=True):
                out["cls"].append(cls)
                out["hashes"].append(shingles(text, width).tobytes())
            yield out

    # shuffled at every size: how many classes are asked for grows with the data. Each text hash is asked for once, so a
    # row meets one asked row at most, whatever ids are repeated or missing; the id only spares other copies of the text
    same = F.col("h").eqNullSafe(F.col("asked_h")) & F.col("doc_id").eqNullSafe(F.col("asked_id"))
    texts = documents.select("doc_id", text_hash().alias("h"), "text").join(asked.hint("merge"), same)
    return map_rows(texts.select("cls", "text"), work, "cls binary, hashes binary").dropDuplicates(["cls"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def compare(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            good = []
            for left, right in zip(batch["ha"], batch["hb"], strict=True):
                x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield {c: [x for x, keep in zip(batch[c], good, strict=True) if keep] for c in ("a", "b")}

    joined = pairs.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")
    return map_rows(joined, compare, "a binary, b binary")


def _open_blocks(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """key, i, j, block, cls, label of the classes that may still be linked with one of another component.

    buckets: key, band, cls, root (smallest class of the bucket, already compared with all others), label (component).
    Pairs of blocks i <= j of a bucket are looked at apart.
    """
    several = buckets.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members"))
    several = stored(several.filter("low <> high and members > 2").select("key", "members"), "open-buckets")
    open_ = buckets.join(several, "key").filter("cls <> root")  # pairs with the root are known
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    open_ = open_.join(classes.select("cls", "n", "registers"), "cls").select(
        "key", "band", "cls", "label", "n", "registers", blocks.alias("blocks"), F.pmod(F.xxhash64("cls"), blocks).cast("int").alias("block")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = open_.select("*", other.alias("other")).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "cls", "label", "n", "registers"
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        rows = rows.sort_values("cls", ignore_index=True)
        registers = np.frombuffer(b"".join(rows.registers), dtype="<u2").reshape(-1, REGISTERS)
        labels, sizes, block, band = pd.factorize(rows.label)[0], rows.n.to_numpy(), rows.block.to_numpy(), int(rows.band.iloc[0])
        taking_part = np.zeros(len(rows), dtype=bool)
        for x in np.flatnonzero(block == i):
            at = np.flatnonzero((labels != labels[x]) & (block == j))
            if i == j:
                at = at[at > x]
            if len(at):
                equal = registers[at] == registers[x]
                near = passes(equal.mean(1), sizes[x], sizes[at], percent)
                at, equal = at[near], equal[near]
                first = equal.reshape(len(at), BANDS, ROWS).all(2).argmax(1)
                at = at[first == band]
                if len(at):
                    taking_part[x] = True
                    taking_part[at] = True
        return rows.loc[taking_part, ["key", "i", "j", "block", "cls", "label"]]

    return paired.groupBy("key", "i", "j").applyInPandas(compare, "key long, i int, j int, block int, cls binary, label binary")


def joining_links(sets: list[np.ndarray], labels: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between members of `left` and `right` (positions) that join components: a spanning forest of all there are."""
    parent = list(range(int(labels.max()) + 1)) if len(labels) else []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    hashes = np.concatenate([sets[k] for k in right])
    owners = np.repeat(np.arange(len(right)), [len(sets[k]) for k in right])
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    sizes = np.array([len(sets[k]) for k in right])
    for x in left:
        low, high = np.searchsorted(hashes, sets[x], "left"), np.searchsorted(hashes, sets[x], "right")
        runs = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
        both = np.bincount(owners[at], minlength=len(right))
        for k in right[100 * both >= percent * (len(sets[x]) + sizes - both)].tolist():
            a, b = root(int(labels[x])), root(int(labels[k]))
            if a != b:
                parent[a] = b
                out.append((int(x), k))
    return out


def _rest(open_blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of different components, on full sets."""

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        rows = rows.sort_values("cls", ignore_index=True)
        block, names = rows.block.to_numpy(), rows.cls.to_numpy()
        hashes = [np.frombuffer(h, dtype=np.uint64) for h in rows.hashes]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = joining_links(hashes, pd.factorize(rows.label)[0], left, right, percent) if len(left) and len(right) else []
        pairs = [sorted((names[x], names[y])) for x, y in links]
        return pd.DataFrame({"a": [a for a, _ in pairs], "b": [b for _, b in pairs]})

    return open_blocks.join(sets, "cls").groupBy("key", "i", "j").applyInPandas(compare, "a binary, b binary")


def _groups(documents: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows; and cls, label, component_id of classes in components of several rows."""
    sketches = stored(_sketches(documents, width), "sketches")
    classes = stored(
        sketches.filter("n > 0").groupBy("cls").agg(
            F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "h")).alias("one"),
            F.first("n").alias("n"), F.first("registers").alias("registers"), F.count(F.lit(1)).alias("members"),
        ).select("cls", "one.doc_id", "one.h", "n", "registers", "members"),
        "classes",
    )
    bands = _bands(classes)
    met = bands.groupBy("key").agg(F.min("cls").alias("root"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    roots = stored(met.select("key", "root"), "roots")
    buckets = stored(bands.join(roots, "key"), "buckets")
    asked = stored(buckets.select("cls").distinct().join(classes, "cls").select("cls", F.col("h").alias("asked_h"), F.col("doc_id").alias("asked_id")), "asked")
    sets = stored(_sets(asked, documents, width), "sets")
    first = buckets.filter("cls <> root").select(F.col("root").alias("a"), F.col("cls").alias("b")).distinct()
    links = stored(_confirmed(_estimated(first, classes, percent), sets, percent), "links")
    found = stored(components(links).toDF("cls", "label"), "components")
    labelled = buckets.join(found, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    open_blocks = stored(_open_blocks(stored(labelled, "labelled"), classes, percent), "open-blocks")
    more = stored(_rest(open_blocks, sets, percent), "links")
    if not more.isEmpty():
        found = stored(components(links.unionByName(more)).toDF("cls", "label"), "components")

    # classes that are more than one document, with the smallest id of their component
    labelled = classes.join(found, "cls", "left").select("cls", "doc_id", "members", F.coalesce("label", "cls").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.sum("members").alias("documents"))
    smallest = stored(smallest.filter("documents > 1").select("label", "component_id"), "smallest")
    return sketches, stored(labelled.join(smallest, "label").select("cls", "label", "component_id"), "named")


def link(documents: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    sketches, named = _groups(documents, width, percent)
    joined = sketches.select("doc_id", "n", "cls").join(named.select("cls", "component_id", F.lit(True).alias("grouped")), "cls", "left")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(documents: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents with one row of each group of near duplicates, with all their columns.

    It is the row with the smallest non-null id, then the smallest text hash, then the smallest other columns.
    """
    sketches, named = _groups(documents, width, percent)
    rows = sketches.select("doc_id", "h", "cls").join(named.select("cls", "label"), "cls")
    ids = rows.groupBy("label", "h", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "copies"))
    texts = stored(ids.groupBy("label", "h").agg(first.alias("one")).select("label", "h", "one.*"), "grouped-texts")
    one = F.min(F.struct("none", "doc_id", "h", "copies"))
    chosen = stored(texts.groupBy("label").agg(one.alias("one")).select("one.h", "one.doc_id", "one.copies"), "chosen")

    key = "_text_hash"
    while any(name.startswith(key) for name in documents.columns):
        key += "_"
    own_id, copies, grouped = f"{key}_id", f"{key}_copies", f"{key}_grouped"
    decided = texts.select("h", F.lit(True)).toDF(key, grouped).join(chosen.toDF(key, own_id, copies), key, "left")
    decided = stored(decided, "decided")
    # shuffled at every size: how many texts are in groups grows with the data
    joined = documents.withColumn(key, text_hash()).join(decided.hint("merge"), key, "left")
    stays = joined.filter(F.isnull(grouped) | F.col(copies).isNotNull() & F.col("doc_id").eqNullSafe(F.col(own_id)))
    if chosen.filter("copies > 1").isEmpty():
        return stays.select(documents.columns)
    # several rows with the chosen id and text: one of them, combined before the shuffle
    stays = stored(stays, "stays")
    sorted_by = [field.name for field in documents.schema if "map<" not in field.dataType.simpleString()]
    least = stays.filter(F.col(copies) > 1).groupBy(key).agg(F.min_by(F.struct(*documents.columns), F.struct(*sorted_by)).alias("row"))
    return stays.filter(F.isnull(copies) | (F.col(copies) == 1)).select(documents.columns).unionByName(least.select("row.*"))
