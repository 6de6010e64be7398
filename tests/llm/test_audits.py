"""Fingerprints, the Merkle log and source divergences against brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tillhouse.llm import divergence, fingerprints, manifest
from tillhouse.llm.common import prepare, ranked, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string, digest int, place int, term string, range string"
EXTRA = ("clash", 1, 2, "x", "y")


def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeioußé", k=rng.randint(2, 7))) for _ in range(120)]
    out = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 150))) for _ in range(160)]
    out += [out[3]] * 6 + [out[4].upper()] * 3
    out += [None, None, "", " ", "A", "z" * 5000, "ab " * 800, "Ab\x00c\x7fD-é_É", "日本 語 🙂 é x" * 40, "word " * 7000]
    out += [" ".join(rng.choices(vocabulary, k=30_000))]
    return out


TEXTS = texts()


def rows():
    rng = random.Random(9)
    langs, sources = ["en", "en", "en", "é", "z", None], ["a", "a", "a", "b", "B", "é", "", None]
    out = [(i, t, rng.choice(langs), rng.choice(sources), rng.choice([len(t or ""), None])) for i, t in enumerate(TEXTS)]
    out += [(7, TEXTS[7], "en", "a", 1), (7, "other text " * 30, "en", "a", 1), (None, "no id " * 20, None, "b", 2), (None, None, "zz", "silent", 0), (-5, "below zero", "single", "q", 10)]
    out += [out[10]] * 4  # repeated rows
    return [row + EXTRA for row in out]


ROWS = rows()


@pytest.fixture(scope="module")
def documents(spark):
    return prepare(spark).createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- ranks ---------------------------------------------------------------------------------


def test_ranks(documents):
    found = ranked(documents.select("doc_id", "lang", "text"), ["lang"], ["doc_id"], "ranks").collect()
    assert len(found) == len(ROWS)
    for lang in {row[2] for row in ROWS}:
        own = sorted((row for row in found if row.lang == lang), key=lambda row: row["rank"])
        assert [row["rank"] for row in own] == list(range(len(own)))
        assert {row.total for row in own} == {len(own)}
        ids = [-math.inf if row.doc_id is None else row.doc_id for row in own]
        assert ids == sorted(ids)


# --- fingerprints --------------------------------------------------------------------------


def entropy_level(window):
    sums = sum(int(fingerprints._WEIGHTS[n]) for n in Counter(window).values())
    return (fingerprints._FULL - sums) * 1000 // fingerprints._FULL


def brute_features(raw, table):
    """Votes range by range, with missing windows at both ends."""
    rank = [int(table[entropy_level(raw[i : i + 64])]) for i in range(len(raw) - 63)]
    votes = Counter()
    for first in range(-63, len(rank)):
        own = [(rank[i], i) for i in range(max(0, first), min(len(rank), first + 64)) if rank[i] >= 0]
        if own:
            votes[min(own)[1]] += 1
    return sorted(i for i, n in votes.items() if n >= 16)


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = sorted((a, b), key=lambda chain: (len(chain), sum(map(len, chain))))
    total = weight = 0
    for own in a:
        best = 0.0
        for other in b:
            chance = len(own) * len(other) / 2048
            spread = math.sqrt(chance * (1 - len(own) / 2048) * (1 - len(other) / 2048))
            if len(own & other) > chance + 4 * spread:
                best = max(best, (len(own & other) - chance) / (min(len(own), len(other)) - chance))
        total, weight = total + len(own) * best, weight + len(own)
    return total / weight


def chain(text):
    """The set bits of each filter."""
    raw = base64.b64decode(text.split(":")[1])
    return [{i for i in range(2048) if raw[k + i // 8] >> i % 8 & 1} for k in range(0, len(raw), 256)]


def test_levels_are_entropies():
    rng = random.Random(2)
    raw = bytes(rng.choices(b"aab cdefgh", k=300)) + b"q" * 100 + bytes(range(256))
    found = fingerprints.levels(np.frombuffer(raw, dtype=np.uint8))
    assert found.tolist() == [entropy_level(raw[i : i + 64]) for i in range(len(raw) - 63)]
    for i in (0, 150, 310, 500):
        exact = -sum(n / 64 * math.log2(n / 64) for n in Counter(raw[i : i + 64]).values())
        assert abs(found[i] - 1000 * exact / 6) <= 1


def test_features(monkeypatch):
    """Alone, all together, and in slices that are shorter than a text."""
    raws = [(t or "").encode()[:3000] for t in TEXTS[:30] + TEXTS[-11:]]
    table = fingerprints.ranks(fingerprints.occurrences(raws))
    wanted = [brute_features(raw, table) for raw in raws]

    def found():
        data, within, ends = fingerprints._joined(raws)
        starts = fingerprints.selected(data, within, table)
        own = np.searchsorted(ends, starts, side="right")
        return [(starts[own == i] - (ends[i] - len(raw))).tolist() for i, raw in enumerate(raws)]

    assert found() == wanted
    counts = Counter(entropy_level(raw[i : i + 64]) for raw in raws for i in range(len(raw) - 63))
    assert fingerprints.occurrences(raws).tolist() == [counts[i] for i in range(1001)]
    before = [fingerprints.written(d) for d in fingerprints.digests(raws, table)]
    monkeypatch.setattr(fingerprints, "SLICE", 200)
    assert found() == wanted
    assert fingerprints.occurrences(raws).tolist() == [counts[i] for i in range(1001)]
    assert [fingerprints.written(d) for d in fingerprints.digests(raws, table)] == before
    assert [fingerprints.written(fingerprints.digests([raw], table)[0]) for raw in raws] == before


def test_filters_of_features():
    raw = TEXTS[-1].encode()
    table = fingerprints.ranks(fingerprints.occurrences([raw]))
    data, within, _ = fingerprints._joined([raw])
    hashes = list(dict.fromkeys(fingerprints.hashes(data, fingerprints.selected(data, within, table)).tolist()))
    wanted = [{h >> 11 * i & 2047 for h in hashes[k : k + 160] for i in range(5)} for k in range(0, len(hashes), 160)]
    ((n, filters),) = fingerprints.digests([raw], table)
    assert n == len(hashes) > 320
    assert chain(fingerprints.written((n, filters))) == wanted
    again, same = fingerprints.read(fingerprints.written((n, filters)))
    assert again == n and (same == filters).all()


def test_compare_edits(documents, nothing):
    found = fingerprints.compare_edits(documents).collect()
    table = fingerprints.rarity(documents)
    key = lambda row: (row[0] is None, -(row[0] or 0), b"" if row[1] is None else hashlib.sha256(row[1].encode()).digest()[:16])
    order = sorted(ROWS, key=key)
    wanted = []
    for i, row in enumerate(order):
        text, following = row[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        own, new, after = (fingerprints.written(fingerprints.digests([t.encode()], table)[0]) for t in (text, edit, following))
        wanted.append((row[0], len(text), sha(edit), own, new, round(brute_likeness(chain(own), chain(new)), 9), round(brute_likeness(chain(own), chain(after)), 9)))
    seen = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert Counter(seen) == Counter(wanted)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    halves = [r.near_edited for r in found if 5 < r.n_features < 50]
    assert len(halves) > 20 and 0.3 < sum(halves) / len(halves) < 0.8
    plain = {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprint(documents, table).collect()}
    assert plain == {(r.doc_id, r.fingerprint) for r in found}
    assert fingerprints.compare_edits(nothing).count() == 0


def test_one_document(spark):
    one = prepare(spark).createDataFrame([(1, "abcdef")], "doc_id long, text string")
    (row,) = fingerprints.compare_edits(one).collect()
    assert (row.n_chars, row.edited_sha256) == (6, sha("abcabc"))


# --- the Merkle log ------------------------------------------------------------------------


def brute_leaf(row, text):
    doc_id, _, lang, source, n_chars = row[:5]
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def brute_tree(nodes):
    """All levels, from the leaves up."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute_way(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        out.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        i //= 8
    return out


def brute_proofs(rows):
    trees = {}
    for lang in sorted({row[2] for row in rows}, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted((-math.inf if r[0] is None else r[0], brute_leaf(r, r[1]), k) for k, r in enumerate(rows) if r[2] == lang)
        trees[lang] = (brute_tree([leaf for _, leaf, _ in own]), [k for _, _, k in own])
    crown = brute_tree([tree[-1][0] for tree, _ in trees.values()])
    root = crown[-1][0]
    out = []
    for at, (tree, places) in enumerate(trees.values()):
        for i, k in enumerate(places):
            row = rows[k]
            way = brute_way(tree, i) + brute_way(crown, at)
            low = row[1] and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            text = row[1].translate({c: c + 32 for c in range(65, 91)}) if low else row[1]
            value = brute_leaf(row, text)
            for left, right in way:
                value = sha(left + value + right)
            out.append((row[0], tree[0][i], tree[-1][0], root, sha("".join(a + b for a, b in way)), value, value == root))
    return out


@pytest.mark.parametrize("levels", [4, 1])
def test_proofs(documents, nothing, levels):
    """Also with blocks so small that there are several rounds of builders."""
    found = manifest.audit(documents, levels).collect()
    assert Counter(map(tuple, found)) == Counter(brute_proofs(ROWS))
    assert {row.verified for row in found} == {True, False}
    if levels == 4:
        assert manifest.audit(nothing).count() == 0


@pytest.mark.parametrize("total", [1, 2, 7, 8, 9, 63, 64, 65, 511, 513, 1000])
def test_log_is_postorder(total):
    """The places of a whole tree are those of a log that one writer appends to."""
    leaves = [hashlib.sha256(bytes([i % 256])).digest() for i in range(total)]
    log, tree = [], brute_tree([leaf.hex() for leaf in leaves])

    def append(level, node):
        if level:
            for child in range(node * 8, min(node * 8 + 8, len(tree[level - 1]))):
                append(level - 1, child)
        log.append((level, node, bytes.fromhex(tree[level][node])))

    append(len(tree) - 1, 0)
    assert manifest.height(total) == len(tree) - 1
    for at, (level, node, value) in enumerate(log):
        assert manifest.place(level, node, total) == at
    assert list(manifest.completed(0, leaves, 0, total)) == log


def test_builders_write_one_log(documents):
    """What the builders of all rounds write is, by language, a log without gaps or repeated places."""
    _, log, _ = manifest.manifest(documents, 1)
    assert len(log) > 2
    found = [row for part in log for row in part.collect()]
    for lang in {row[2] for row in ROWS}:
        places = sorted(row.place for row in found if row.lang == lang)
        assert places == list(range(len(places)))


# --- source divergence ---------------------------------------------------------------------


def brute_divergence(rows, least):
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    counts, within = {}, {}
    for row in rows:
        lang, source = row[2] or "", row[3] or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (row[1] or "").translate(lower))
        counts.setdefault((lang, source), Counter()).update(found)
        within.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang, seen in within.items():
        kept = sorted((t for t, n in seen.items() if n >= least), key=str.encode)
        groups = {source: own for (own_lang, source), own in counts.items() if own_lang == lang}

        def shares(own, kept=kept):
            total = sum(own[t] for t in kept)
            return [1 + math.floor(Fraction(10**9 * (own[t] + 2), total + 2 * len(kept))) for t in kept]

        p = {source: shares(own) for source, own in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for source, own in groups.items():
            pairs = [(other, sum(map(f, p[source], p[other]))) for other in groups if other != source]
            more = [(t, f(a, b)) for t, a, b in zip(kept, p[source], q, strict=True) if own[t] and a > b]
            for part, items in (("pair", pairs), ("term", more)):
                items.sort(key=lambda item: (-item[1], item[0].encode()))
                out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(items, 1) if part == "pair" or rank <= 10]
    return out


@pytest.mark.parametrize(("sources", "terms", "least"), [(32, 2048, 10), (2, 7, 10), (1, 50, 3), (3, 1, 10)])
def test_divergence(documents, sources, terms, least):
    """Also with cells so small that there are many along every axis."""
    found = divergence.audit(documents, least=least, sources=sources, terms_=terms).collect()
    assert Counter(map(tuple, found)) == Counter(brute_divergence(ROWS, least))


def test_divergence_of_nothing(nothing, documents):
    assert divergence.audit(nothing).count() == 0
    none = divergence.audit(documents, least=10_000).collect()
    assert none and {(row.part, row.value) for row in none} == {("pair", 0)}


def test_shares_are_exact():
    rng = np.random.default_rng(4)
    for total, kept in ((10**15, 10**6), (7, 3), (0, 1), (10**9, 10**5)):
        counts = np.concatenate([[0, total], rng.integers(0, total + 1, 50)])
        wanted = [1 + 10**9 * (int(c) + 2) // (total + 2 * kept) for c in counts]
        assert divergence.shares(counts, total, kept).tolist() == wanted


def test_terms_of_odd_texts():
    for text in TEXTS:
        wanted = [m.translate({c: c + 32 for c in range(65, 91)}).encode() for m in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        assert divergence.terms(text) == wanted


def test_ranks_are_read_from_a_table(documents):
    """A second use of the ranks gives the same rows."""
    kept = stored(ranked(documents.select("doc_id", "lang"), [], ["lang"], "all"), "kept")
    assert sorted(row["rank"] for row in kept.collect()) == list(range(len(ROWS)))
