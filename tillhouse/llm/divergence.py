"""Divergence between the sources of a language, and the terms that set a source apart.

Every source has a smoothed share of each term that its language keeps; the divergence of two sources is the sum over
terms of f(p, q) = floor((p - q)**2 / (p + q)) on shares in parts of a billion. All arithmetic is exact.

The pairs of sources and the terms span a cube. It is cut along all three axes: a cell is a block of SOURCES sources, another
such block and a block of TERMS terms, and its task gets two slices of the counts, those of its two blocks of
sources over its block of terms. A slice goes to every cell that needs it, so no task sees a whole source, a whole language or a
whole vocabulary, and a cell holds 2 * SOURCES * TERMS counts at most. Cells give partial sums for their pairs, which Spark
adds up along the axis of terms. The cells of a block with itself get the counts of the whole language, too, and give the best
terms of each source among theirs; these are merged along the same axis.

Defined results: NULL texts, languages and sources are ''. A source without terms, or without any kept term, has the
smoothed shares of a source that says nothing. A language without kept terms has divergences of 0 and no terms. Texts are read
whole. Repeated rows count as documents of their own, ids take no part. Ties go by UTF-8. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import map_rows, ranked, stored

#: Documents of its language a term has to be in, and best terms of a source.
LEAST, BEST = 10, 10
#: Sources and terms on the edges of a cell.
SOURCES, TERMS = 32, 2048
#: Counts a task holds before it hands them on.
HELD = 300_000
PARTS = 1_000_000_000

#: What is no letter becomes a space, A-Z small; all bytes of other characters stay.
_LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Matches of [^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+ with A-Z in lower case."""
    return text.encode().translate(_LETTERS).split() if text else []


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(PARTS * (count + 2) / (total + 2 * kept)), by long division in steps of a thousand."""
    rest = counts.astype(np.int64) + 2
    under = total + 2 * kept
    found = np.zeros_like(rest)
    for _ in range(3):
        rest *= 1000
        found = found * 1000 + rest // under
        rest %= under
    return found + 1


def parted(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q))."""
    return (p - q) ** 2 // (p + q)


def counted(documents: DataFrame) -> DataFrame:
    """lang, source, term, c (occurrences), d (documents); the term '' stands for the source itself."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def handed() -> Iterator[dict[str, list]]:
            for (lang, source), (total, within) in held.items():
                n = len(total)
                yield {"lang": [lang] * n, "source": [source] * n, "term": list(total), "c": list(total.values()), "d": [within[t] for t in total]}
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
                total, within = held.setdefault((lang, source), (Counter({b"": 0}), Counter()))
                found = Counter(terms(text))
                size -= len(total)
                total.update(found)
                within.update(found.keys())
                size += len(total)
            if size > HELD:
                yield from handed()
                size = 0
        yield from handed()

    texts = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    found = map_rows(texts, work, "lang string, source string, term binary, c long, d long")
    return found.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def slices(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of kept terms (lang, g, t, c), sources (lang, source, g, of, n, v), kept terms (lang, term, t, v).

    g and t number the sources and the terms of a language, of and v are their numbers, n is a source's count over kept terms.
    g is -1 for the language as a whole.
    """
    summed = stored(counted(documents), "term-counts")
    per_term = summed.filter(F.octet_length("term") > 0).groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("c").alias("c"))
    kept = ranked(per_term.filter(F.col("d") >= least).drop("d"), ["lang"], ["term"], "kept-terms")
    kept = stored(kept.select("lang", "term", "c", F.col("rank").alias("t"), F.col("total").alias("v")), "kept")
    groups = ranked(summed.filter(F.octet_length("term") == 0).select("lang", "source"), ["lang"], ["source"], "groups")
    groups = stored(groups.select("lang", "source", F.col("rank").alias("g"), F.col("total").alias("of")), "sources")
    said = summed.filter("c > 0").join(kept.select("lang", "term", "t"), ["lang", "term"]).join(groups.drop("of"), ["lang", "source"])
    said = said.select("lang", "g", "t", "c").unionByName(kept.select("lang", F.lit(-1).cast("long").alias("g"), "t", "c"))
    said = stored(said, "counts")
    total = said.groupBy("lang", "g").agg(F.sum("c").alias("n"))
    sizes = kept.groupBy("lang").agg(F.first("v").alias("v"))
    whole = groups.groupBy("lang").agg(F.first("of").alias("of")).select("lang", F.lit(None).cast("string").alias("source"), F.lit(-1).cast("long").alias("g"), "of")
    groups = groups.unionByName(whole).join(total, ["lang", "g"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", "g", "of", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    return said, stored(groups, "source-totals"), kept


def cells(said: DataFrame, groups: DataFrame, sources: int, terms_: int) -> DataFrame:
    """Every slice at every cell that needs it: lang, a, b, k (the cell), g, t, c; rows of t = -1 name a source, its count n and v."""
    of = groups.filter("g = -1").select("lang", F.ceil(F.col("of") / sources).cast("long").alias("blocks"), "v")
    own = F.floor(F.col("g") / sources).cast("long")
    # the language as a whole goes to the cells of every block with itself
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    first = F.when(F.col("g") < 0, F.col("other")).otherwise(F.least(own, "other"))
    second = F.when(F.col("g") < 0, F.col("other")).otherwise(F.greatest(own, "other"))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumn("other", other).select("lang", first.alias("a"), second.alias("b"), "k", "g", "t", "c", "n", "v")

    none = [F.lit(None).cast("long").alias(c) for c in ("n", "v")]
    counts = said.join(of.select("lang", "blocks"), "lang").select("lang", "blocks", F.floor(F.col("t") / terms_).cast("long").alias("k"), "g", "t", "c", *none)
    last = F.floor((F.greatest(F.col("v"), F.lit(1)) - 1) / terms_).cast("long")
    heads = groups.drop("v").join(of, "lang").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    heads = heads.select("lang", "blocks", "k", "g", F.lit(-1).cast("long").alias("t"), F.lit(0).cast("long").alias("c"), "n", "v")
    return dealt(heads).unionByName(dealt(counts))


def cell(
    g: np.ndarray, t: np.ndarray, c: np.ndarray, n: np.ndarray, start: int, width: int, v: int, sources: int, best: int
) -> tuple[np.ndarray, np.ndarray]:
    """Partial sums (g, h, value) of a cell's pairs, and (g, t, value) of the best terms that its sources say more than their language.

    Rows with t = -1 name the sources, with their count n over all kept terms. The cell has the terms from start, width of the v
    that the language keeps; without kept terms there is nothing to add up, but the pairs are there.
    """
    heads = t < 0
    names, totals = g[heads], n[heads]
    order = np.argsort(names)
    names, totals = names[order], totals[order]
    rows = ~heads
    table = np.zeros((len(names), width), dtype=np.int64)
    table[np.searchsorted(names, g[rows]), t[rows] - start] = c[rows]
    p = np.stack([shares(own, int(total), v) for own, total in zip(table, totals, strict=True)]) if width else table
    found, better = [], []
    whole = np.flatnonzero(names < 0)
    blocks = names // sources
    low = blocks[names >= 0].min()
    same = blocks.max() == low
    for i, name in enumerate(names):
        if name < 0 or blocks[i] != low:
            continue
        others = np.flatnonzero((names > name) & (blocks == low) if same else blocks != low)
        if len(others):
            values = parted(p[i], p[others]).sum(axis=1) if width else np.zeros(len(others), dtype=np.int64)
            found.append(np.stack([np.full(len(others), name), names[others], values]))
        if len(whole) and width:
            q = p[whole[0]]
            more = np.flatnonzero((table[i] > 0) & (p[i] > q))
            values = parted(p[i][more], q[more])
            top = np.lexsort((more, -values))[:best]
            better.append(np.stack([np.full(len(top), name), more[top] + start, values[top]]))
    none = np.zeros((3, 0), dtype=np.int64)
    return np.concatenate([none, *found], axis=1), np.concatenate([none, *better], axis=1)


def partial(said: DataFrame, groups: DataFrame, sources: int, terms_: int, best: int) -> DataFrame:
    """lang, part, g, item (source or term number), value of every cell."""

    def run(table: pa.Table) -> pa.Table:
        g, t, c, n, v = (pc.fill_null(table.column(name), 0).to_numpy() for name in ("g", "t", "c", "n", "v"))
        start, kept = table.column("k")[0].as_py() * terms_, int(v.max())
        pairs, better = cell(g, t, c, n, start, min(terms_, kept - start), kept, sources, best)
        lang = table.column("lang")[0].as_py()
        size = pairs.shape[1] + better.shape[1]
        both = np.concatenate([pairs, better], axis=1)
        part = ["pair"] * pairs.shape[1] + ["term"] * better.shape[1]
        return pa.table(
            {
                "lang": pa.array([lang] * size, pa.string()),
                "part": pa.array(part, pa.string()),
                **{name: pa.array(values, pa.int64()) for name, values in zip(("g", "item", "value"), both, strict=True)},
            }
        )

    dealt = cells(said, groups, sources, terms_)
    return dealt.groupBy("lang", "a", "b", "k").applyInArrow(run, "lang string, part string, g long, item long, value long")


def audit(documents: DataFrame, least: int = LEAST, best: int = BEST, sources: int = SOURCES, terms_: int = TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part 'pair' has every other source of the language, 'term' the best terms."""
    said, groups, kept = slices(documents, least)
    found = stored(partial(said, groups, sources, terms_, best), "partial")
    pairs = found.filter("part = 'pair'").groupBy("lang", "g", "item").agg(F.sum("value").alias("value"))
    turned = pairs.select("lang", F.col("item").alias("g"), F.col("g").alias("item"), "value")
    named = groups.filter("g >= 0").select("lang", F.col("g").alias("item"), F.col("source").alias("name"))
    pairs = pairs.unionByName(turned).join(named, ["lang", "item"])

    def placed(df: DataFrame, by: str) -> DataFrame:
        order = Window.partitionBy("lang", "g").orderBy(F.desc("value"), by)
        return df.withColumn("rank", F.row_number().over(order))

    pairs = placed(pairs, "name").select("lang", "g", F.lit("pair").alias("part"), "name", "value", "rank")
    top = placed(found.filter("part = 'term'"), "item").filter(F.col("rank") <= best)
    words = kept.select("lang", F.col("t").alias("item"), F.col("term").cast("string").alias("name"))
    top = top.join(words, ["lang", "item"]).select("lang", "g", "part", "name", "value", "rank")
    owners = groups.filter("g >= 0").select("lang", "g", "source")
    return pairs.unionByName(top).join(owners, ["lang", "g"]).select("lang", "source", "part", F.col("name").alias("item"), "value", "rank")
