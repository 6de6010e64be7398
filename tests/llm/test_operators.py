"""Every text operator against brute force or its library, on a fixture with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillhouse.llm import (
    bytepair,
    language,
    licenses,
    likelihood,
    near_duplicates,
    neighbours,
    packing,
    pieces,
    quality,
    repeats,
    token_counts,
)
from tillhouse.llm.common import map_rows, prepare
from tillhouse.llm.graph import components

SYLLABLES = {"en": "the on ing ed th er an re".split(), "xx": "qu oi eau ié ç le ment ré".split()}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, h int, n int, label string"


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def texts():
    rng = random.Random(3)
    out = [prose(rng, rng.choice(["en", "xx"]), rng.randint(60, 220)) for _ in range(40)]
    passage = prose(rng, "en", 120)
    out += [f"{prose(rng, 'en', 30)} {passage} {prose(rng, 'en', 30)}" for _ in range(6)]
    base = out[0].split()
    for k in range(12):  # near copies at various distances, in a chain and around one text
        words = list(base)
        for _ in range(k):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        out.append(" ".join(words))
    out += [out[1]] * 5
    out += [None, "", " ", "one", "one two", "ONE two", "a\n\nb  c\t<|endoftext|> d", "日本 語 🙂 é x", "x" * 3000, "ab " * 700, "A" * 450 + "é" * 450]
    out += [prose(rng, "en", 5000)]
    return out


TEXTS = texts()
ROWS = [(i, t, "en" if i % 2 else "xx", "s", len(t or ""), "clash", 1, 2, "z") for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def documents(spark):
    """Extra columns have the names of the operators' own."""
    return prepare(spark).createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


def by_id(df):
    return {row.doc_id: row for row in df.collect()}


def raw(text):
    return (text or "").encode()


def test_token_counts(documents, nothing):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = by_id(token_counts.count_tokens(documents))
    for i, text in enumerate(TEXTS):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len(raw(text)), n, n > 512)
    assert token_counts.count_tokens(nothing).count() == 0


def test_byte_pairs_of_every_safe_character():
    """Each character the own pattern is used for, in several surroundings."""
    known = bytepair.encoder("byte_bpe_50k.json")
    safe = [chr(c) for c in range(0x250)] + [chr(c) for c in (*range(0x2010, 0x2028), *range(0x2030, 0x205F))]
    cases = [f"{a}{c}{b}" for c in safe for a, b in (("a", "b"), (" ", "1"), (" .", " "), ("\n", "\n"), (c, " x"), ("'", "s "))]
    for case, wanted in zip(cases, known.library.encode_batch(cases, add_special_tokens=False), strict=True):
        assert np.frombuffer(known.ids(case), dtype="<u4").tolist() == wanted.ids, repr(case)
        assert token_counts.n_tokens(case, {}, known) == len(wanted.ids)


def test_pieces(documents, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = by_id(pieces.encode_and_decode(documents))
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "")
        wanted = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), library.decode(ids) if ids else "")]
        assert [found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256] == [len(ids), *wanted]
    assert pieces.encode_and_decode(nothing).count() == 0


@pytest.mark.parametrize("alphabet", ["ab ", "  \n\tx", "thanoinger ", "éèà ß", "▁ a", "日本語 가", "0123 .,"])
def test_pieces_of_random_texts(alphabet):
    rng, known = random.Random(alphabet), pieces.encoder("piece_bpe_32k.model")
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 30)))
        assert known.encode(text) == known.library.encode(text), repr(text)


def brute_components(width, percent):
    sets = []
    for text in TEXTS:
        found = raw(text).lower().split()
        sets.append({tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))} if found else set())
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sets, [root(i) for i in range(len(sets))]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80), (3, 60)])
def test_near_duplicates(documents, width, percent):
    sets, roots = brute_components(width, percent)
    found = by_id(near_duplicates.link(documents, width, percent))
    for i in range(len(TEXTS)):
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (len(sets[i]), roots[i], roots[i] == i)


def test_near_duplicates_in_small_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    _, roots = brute_components(3, 85)
    found = by_id(near_duplicates.link(documents, 3, 85))
    assert [found[i].component_id for i in range(len(TEXTS))] == roots


def test_one_of_each_group_stays(documents, nothing):
    _, roots = brute_components(5, 80)
    kept = near_duplicates.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(roots))
    assert near_duplicates.keep_one(nothing).count() == 0


def test_near_duplicates_without_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (None, "x y z"), (3, None)]
    found = near_duplicates.link(prepare(spark).createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    key = lambda row: str(row)
    assert sorted([(r.doc_id, r.component_id, r.kept) for r in found], key=key) == sorted(
        [(None, 7, False), (None, 7, False), (7, 7, True), (None, None, True), (3, 3, True)], key=key
    )


def test_one_row_of_each_group_stays(spark):
    """With repeated rows, without ids, and with two texts under one id; what stays is not emptied by the next stage."""
    rng = random.Random(12)
    a, b, c, d, e, f = (prose(rng, "en", 120) for _ in range(6))
    near = a + " one more"
    rows = [(1, a, 0), (1, a, 0), (1, a, 1), (2, near, 2)]  # a repeated row, a row with another column, a near copy
    rows += [(None, b, 3), (None, b, 3), (None, b, 4)]  # copies without ids
    rows += [(9, c, 5), (None, c, 6), (8, c, 7)]  # some of the ids are missing
    rows += [(3, d, 8), (3, near, 9)]  # two texts under one id, one of them a near copy
    rows += [(4, e, 10), (4, f, 11), (4, f + " end", 12)]  # and a group under a single id
    rows += [(5, None, 13), (5, None, 13), (None, "", 14), (None, "", 14)]  # linked with nothing
    frame = prepare(spark).createDataFrame([(*row, {"k": "v"}) for row in rows], "doc_id long, text string, label int, h map<string,string>").repartition(4)
    kept = near_duplicates.keep_one(frame)
    assert kept.schema == frame.schema
    got = sorted((r.label, r.doc_id, r.text) for r in kept.collect())
    last = min([(f, 11), (f + " end", 12)], key=lambda x: hashlib.sha256(x[0].encode()).digest())
    wanted = [(0, 1, a), (3, None, b), (7, 8, c), (8, 3, d), (10, 4, e), (last[1], 4, last[0])]
    assert [g for g in got if g[0] < 13] == wanted and [g[0] for g in got if g[0] >= 13] == [13, 13, 14, 14]
    assert all(r.text for r in repeats.strip(kept).collect() if r.label < 13)
    distinct = frame.filter("label in (2, 5, 8, 10)")
    assert sorted(r.label for r in near_duplicates.keep_one(distinct).collect()) == [2, 5, 8, 10]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        both = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        n = int(2000 * (1 - share) / share / 2)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n, dtype=np.uint64)])) for _ in range(2))
        agree = (near_duplicates.sketch(a) == near_duplicates.sketch(b)).mean()
        assert abs(agree - share) < 0.12


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = {row.node: row.root for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert found == {x: root(x) for x in parent if any(a != b and x in (a, b) for a, b in edges)}


def brute_covered(datas, length):
    counts = Counter(d[s : s + length] for d in datas for s in range(len(d) - length + 1))
    out = []
    for d in datas:
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if counts[d[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        out.append(gone)
    return out


def test_texts_without_ids_are_fetched_once(spark, monkeypatch):
    """Many texts under NULL or one id: rows that reach the workers do not grow with their product, results are right."""
    rng = random.Random(21)
    passages = [prose(rng, "en", 40) for _ in range(20)]
    rows = [(own, f"{prose(rng, 'en', 8)} {passages[i]} {prose(rng, 'en', 8)}") for own in (None, 7) for i in range(20)]
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(2).cache()
    read = spark.sparkContext.accumulator(0)

    def counted(df, work, schema, plain=map_rows):
        if not {"places", "cls"} & set(df.columns) or "text" not in df.columns:
            return plain(df, work, schema)

        def run(batches):
            def seen():
                for batch in batches:
                    read.add(len(batch["text"]))
                    yield batch

            return work(seen())

        return plain(df, run, schema)

    monkeypatch.setattr(near_duplicates, "map_rows", counted)
    monkeypatch.setattr(repeats, "map_rows", counted)
    found = repeats.remove(frame, 100).collect()
    gone = brute_covered([raw(t) for _, t in rows], 100)
    assert sorted(r.n_removed for r in found) == sorted(sum(g) for g in gone) and sum(map(sum, gone))
    assert 0 < read.value <= 2 * len(rows)
    near = [(own, text) for own, text in rows] + [(own, f"{text} end") for own, text in rows]
    before = read.value
    linked = near_duplicates.link(spark.createDataFrame(near, "doc_id long, text string"), 3, 85).collect()
    assert len(linked) == len(near) and 0 < read.value - before <= 2 * len(near)


@pytest.mark.parametrize(("length", "most", "size"), [(400, 4096, 1 << 21), (30, 4096, 1 << 21), (30, 1, 64), (100, 2, 256)])
def test_repeats(documents, monkeypatch, length, most, size):
    """Also with names whose contexts are merged in Spark, and with texts longer than a slice."""
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    monkeypatch.setattr(repeats, "SLICE", size)
    found = by_id(repeats.remove(documents, length))
    datas = [raw(t) for t in TEXTS]
    for i, (data, gone) in enumerate(zip(datas, brute_covered(datas, length), strict=True)):
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        assert (found[i].n_bytes, found[i].n_removed, found[i].n_spans, found[i].kept_sha256) == (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    for i, gone in enumerate(brute_covered(datas, min(length, repeats.PASSAGE))):
        assert found[i].n_repeated == sum(gone)


def test_passages_of_over_fifty_words_are_seen(spark):
    """A passage of 51 words, about 300 bytes, in two documents: counted, and removed at the pipeline's length."""
    rng = random.Random(12)
    passage = prose(rng, "en", 51)
    assert repeats.PASSAGE < len(passage) < 400
    rows = [(i, f"{prose(rng, 'xx', 80)} {passage if i < 2 else ''} {prose(rng, 'xx', 80)}") for i in range(6)]
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    found = by_id(repeats.remove(frame))
    assert [found[i].n_removed for i in range(6)] == [0] * 6
    assert all((found[i].n_repeated >= len(passage)) == (i < 2) for i in range(6))
    left = by_id(repeats.strip(frame, repeats.PASSAGE))
    assert all(passage not in left[i].text for i in range(2)) and all(left[i].text == rows[i][1] for i in range(2, 6))


def test_texts_without_long_repeats_stay_out(spark):
    """The second search sees the texts that can have long repeats, whatever share of all texts they are."""
    rng = random.Random(14)
    long = prose(rng, "en", 150)
    rows = [(i, f"{prose(rng, 'xx', 90)} {long if i < 3 else long[:280] if i < 6 else ''} {prose(rng, 'xx', 90)}") for i in range(40)]
    rows += [(100 + i, rows[30][1]) for i in range(2)]
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    short = repeats._spans(frame, 250)
    kept = {row.doc_id for row in repeats._long_repeats(frame, short, 400).collect()}
    assert {0, 1, 2, 30, 100, 101} <= kept and len(kept) <= 8
    gone = brute_covered([raw(t) for _, t in rows], 400)
    found = by_id(repeats.remove(frame))
    assert [found[i].n_removed for i, _ in rows] == [sum(g) for g in gone]


@pytest.mark.parametrize("size", [256, 1 << 21])
def test_texts_are_sampled_together(monkeypatch, size):
    """The samples of texts hashed in one piece are those of each text alone."""
    monkeypatch.setattr(repeats, "SLICE", size)
    rng = random.Random(31)
    common = prose(rng, "en", 25)
    datas = [f"{prose(rng, 'xx', rng.randint(20, 90))} {common}".encode() for _ in range(30)]
    offsets = np.cumsum([0, *map(len, datas)])
    seen, joined = [], np.frombuffer(b"".join(datas), dtype=np.uint8)
    for rows, begin, end, start in repeats._chunks(offsets, 100):
        *parts, text = repeats.samples(joined[begin:end], offsets[rows] - (begin - start), 100, 40)
        seen += [(rows[t], n, c, p + start, a + start, b + start) for n, c, p, a, b, t in zip(*parts, text, strict=True)]
    alone = []
    for i, data in enumerate(datas):
        for start in range(0, len(data) - 99, size):
            parts = repeats.samples(np.frombuffer(data[start : start + size + 99], dtype=np.uint8), np.array([0]), 100, 40)
            alone += [(i, n, c, p + start, a + start, b + start) for n, c, p, a, b, _ in zip(*parts, strict=True)]
    assert seen == alone
    for i, data in enumerate(datas):  # every start is in one run
        assert [k for row, *_, a, b in seen if row == i for k in range(a, b + 1)] == list(range(len(data) - 99))


def test_spans_are_united_before_they_are_stored(spark):
    """A long repeated passage is one interval, not one for each of its samples; intervals of different texts stay apart."""
    rng = random.Random(32)
    passage = prose(rng, "en", 400)
    rows = [(i, f"{prose(rng, 'xx', 60)} {passage} {prose(rng, 'xx', 60)} {passage[900:1400] if i == 1 else ''}") for i in range(4)]
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(1)
    found = sorted([(s.start, s.end) for s in row.spans] for row in repeats._spans(frame, 250).collect())
    gone = brute_covered([raw(t) for _, t in rows], 250)
    runs = [[m.span() for m in re.finditer(b"\1+", bytes(own))] for own in gone]
    assert found == sorted(runs) and sorted(map(len, found)) == [1, 1, 1, 2]


@pytest.mark.parametrize("most", [4096, 1])
def test_repeated_rows_share_passages_with_others(spark, monkeypatch, most):
    """Rows that agree in id and text give each context once, however many there are."""
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    monkeypatch.setattr(repeats, "MERGED", 3)
    rng = random.Random(33)
    passage = prose(rng, "en", 60)
    rows = [(own, text) for own in (None, 5) for text in [f"{prose(rng, 'xx', 30)} {passage} {prose(rng, 'xx', 30)}"] for _ in range(6)]
    rows += [(i, f"{prose(rng, 'xx', 40)} {passage[i:]} {prose(rng, 'xx', 20)}") for i in (20, 33)] + [(60, prose(rng, "xx", 90))]
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = brute_covered([raw(t) for _, t in rows], 100)
    found = sorted((r.doc_id or 0, r.n_removed) for r in repeats.remove(frame, 100).collect())
    assert found == sorted((i or 0, sum(g)) for (i, _), g in zip(rows, gone, strict=True))


def test_stripped_documents_keep_their_columns(documents, nothing):
    found = repeats.strip(documents)
    assert found.schema == documents.schema
    datas = [raw(t) for t in TEXTS]
    rows = by_id(found)
    for i, (data, gone) in enumerate(zip(datas, brute_covered(datas, 400), strict=True)):
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g).decode(errors="ignore")
        assert (rows[i].text or "") == kept and rows[i].n_chars == len(kept) and rows[i].n_tokens == "clash"
    assert repeats.strip(nothing).count() == 0 and repeats.remove(nothing).count() == 0


def test_packing(documents, nothing):
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(documents, capacity=100).collect()
    for i, text in enumerate(TEXTS):
        ids = np.array(known.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == 100 or r is own[0]
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    assert len(sequences) <= 1.05 * sum(r.length for r in rows) / 100 + 2
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_once(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(1, 63) for _ in range(rng.choice([1, 50, 5000])))
    segments, used = packing.plan(counts, 64, rng.choice([3, 20, 100]))
    where, ranks = {}, {}
    for s in segments:
        for k in range(s.count):
            where.setdefault(s.first + k, []).append((s.offset, s.length))
            ranks.setdefault(s.length, []).append(s.rank + k)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert set(where) == set(range(used))
    for parts in where.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1].tolist()]
        assert sum(n for _, n in parts) <= 64


def test_likelihood(documents, nothing, monkeypatch):
    monkeypatch.setattr(likelihood, "HELD", 50)  # counts are handed on in parts
    found = by_id(likelihood.score(documents, hot=20))
    words = [raw(t).lower().split() for t in TEXTS]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(TEXTS))]
    counts = Counter(w for i, ws in enumerate(words) if not held[i] for w in ws)
    n_train = held.count(False)
    n, v = sum(counts.values()) + n_train, len(counts) + 1
    term = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    for i, ws in enumerate(words):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(ws) + 1, n)
        assert r.n_known == sum(w in counts for w in ws) + 1
        assert math.isclose(r.base_score, sum(term(counts[w]) for w in ws) + term(n_train), rel_tol=1e-9)
        assert r.score < 0
    # the same however many words are broadcast
    other = by_id(likelihood.score(documents, hot=100_000))
    assert all(math.isclose(found[i].score, other[i].score, rel_tol=1e-9) for i in found)
    assert likelihood.score(nothing).count() == 0


def test_lattice_sums_all_segmentations():
    known = pieces.encoder("piece_bpe_32k.model")
    p = np.random.default_rng(4).random(known.library.get_piece_size())
    p /= p.sum()
    lattice = likelihood.Lattice("piece_bpe_32k.model", p)

    def brute(text):
        if not text:
            return 1.0
        total = sum(lattice.p[text[:k]] * brute(text[k:]) for k in range(1, len(text) + 1) if text[:k] in lattice.p)
        if text[0] not in lattice.p:
            total += math.prod(lattice.bytes_[b] for b in text[0].encode()) * brute(text[1:])
        return total

    for word in ("the", "thering", "a🙂b", "éèeau", "x" * 9):
        assert math.isclose(lattice.log10(word), math.log10(brute(pieces.SPACE + word)), rel_tol=1e-9)
    linear = lattice.log10("onthering" * 4)
    likelihood_linear, likelihood.LINEAR = likelihood.LINEAR, 0
    try:
        assert math.isclose(linear, lattice.log10("onthering" * 4), rel_tol=1e-9)
    finally:
        likelihood.LINEAR = likelihood_linear
    assert math.isfinite(lattice.log10("x" * 5000))


def test_language(spark, nothing):
    rng = random.Random(9)
    rows = [(i, prose(rng, lang, rng.randint(15, 80)), lang) for i, lang in enumerate(["en", "xx"] * 60)]
    learn = prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(learn, per_language=30, clusters=3)
    odd = [(1000, None, None), (1001, "", "en"), (1002, "12 -- ¿? 🙂", "en"), (1003, "ŋŋŋ жжж ψψψ щщщ юююю " * 20, "en"), *[(r[0], r[1], None) for r in rows]]
    found = by_id(language.identify(spark.createDataFrame(odd, "doc_id long, text string, score string"), model))
    assert all(found[i].lang_pred == lang and 0 < found[i].score <= 1 and not found[i].rejected for i, _, lang in rows)
    assert all((found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True) for i in (1000, 1001, 1002))
    assert found[1003].rejected and found[1003].lang_pred in ("en", "xx")
    assert language.train(nothing) is None
    assert all(row.lang_pred == "und" for row in language.identify(learn, None).collect())
    assert language.keep_known(nothing, model).count() == 0


def test_documents_that_stay_by_language(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, lang, rng.randint(15, 80)), lang) for i, lang in enumerate(["en", "xx"] * 30)]
    learn = prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    unlearned = [(100 + i, " ".join("".join(rng.choices("жщюфы", k=5)) for _ in range(60)), None) for i in range(5)]
    both = spark.createDataFrame(rows + unlearned, learn.schema)
    assert sorted(r.doc_id for r in language.keep_known(both, language.train(learn)).collect()) == list(range(60))
    # no row has a language: there is nothing to reject by
    unlabelled = both.withColumn("lang", F.lit(None).cast("string"))
    assert language.keep_known(unlabelled, language.train(unlabelled)).count() == 65


def test_grams_of_slices(monkeypatch):
    text = "The quick  BROWN fox, élan 𐐷𐐷 x"
    whole = language.grams(text)
    assert whole.sum() and not language.grams("12 !!").any()
    monkeypatch.setattr(language, "SLICE", 7)
    assert (language.grams(text) > 0).sum() >= (whole > 0).sum()


def test_quality_counts(documents, nothing):
    found = by_id(quality.assess(documents, None))
    for i, text in enumerate(TEXTS):
        words = raw(text).split()
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        seen, duplicates = set(), 0
        for line in (text or "").split("\n"):
            if line.encode().split():
                duplicates += line in seen
                seen.add(line)
        r = found[i]
        assert (r.n_words, r.word_chars) == (len(words), sum(len(w.decode()) for w in words))
        assert (r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(repeated))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and r.kept == (not r.base_failed)
    assert quality.assess(nothing, None).count() == 0


def test_line_field(spark):
    rng = random.Random(2)
    clean = [(i, "\n".join(prose(rng, "en", 40) + "." for _ in range(4)), 1) for i in range(40)]
    junk = [(100 + i, "\n".join((prose(rng, "en", 25) + "!! ").upper().replace(" ", "!! ") for _ in range(4)), 0) for i in range(40)]
    frame = prepare(spark).createDataFrame(clean + junk, "doc_id long, text string, quality int")
    field = quality.train(frame.drop("quality"), frame.drop("text"), n=20)
    found = by_id(quality.assess(frame, field))
    assert all(found[i].kept for i, _, _ in clean) and not any(found[i].kept for i, _, _ in junk)
    assert sorted(r.doc_id for r in quality.keep_good(frame, field).collect()) == [i for i, _, _ in clean]
    mixed = clean[0][1] + "\n" + junk[0][1]
    assert 0.2 < quality.judge(mixed, field)[6] < 0.8
    assert quality.train(frame.drop("quality"), frame.drop("text").limit(0)) is None


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    field = quality.Field(rng.normal(size=(2, quality.FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))
    x = rng.normal(size=(7, quality.FEATURES))
    scores = x @ field.emission.T

    def score(path):
        return field.start[path[0]] + sum(scores[t, s] for t, s in enumerate(path)) + sum(field.transition[a, b] for a, b in zip(path, path[1:], strict=False))

    best = max(np.ndindex(*[2] * 7), key=score)
    assert quality.viterbi(x, field).tolist() == list(best)


def test_neighbours(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    vectors = [list(map(float, centres[i % 12] + 0.3 * rng.normal(size=16))) for i in range(900)]
    for i in range(300, 400):  # a hundred copies, longer than the others: ties go to the smallest ids
        vectors[i] = [3 * c for c in vectors[300]] if i == 300 else vectors[300]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(5, vectors[5]), (2000, None), (2020, [0.0] * 16), (2040, [1.0, None]), (2060, [float("nan")] * 16), (None, vectors[0]), (2080, [])]
    frame = prepare(spark).createDataFrame([(*row, "x", 1, 2) for row in rows], "vec_id long, embedding array<float>, rank string, score int, label int")
    found = {}
    for row in neighbours.search(frame, k=20, every=20).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    x = np.array(vectors, dtype=np.float32).astype(float)
    assert set(found) == set(range(0, 900, 20))
    hits = 0
    for q, got in found.items():
        got.sort()
        scores = x @ x[q]
        assert [r for r, _, _ in got] == list(range(1, 21)) and q not in [i for _, i, _ in got]
        assert all(math.isclose(s, scores[i], rel_tol=1e-12) for _, i, s in got)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(900), -np.round(scores, 9)))[:20]
        hits += len(set(best.tolist()) & {i for _, i, _ in got})
    assert hits >= 0.9 * 20 * len(found)
    copies = [i for _, i, _ in found[320]][:19]
    assert copies == list(range(300, 319))
    assert neighbours.search(frame.limit(0)).count() == 0


def test_few_neighbours(spark):
    frame = prepare(spark).createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.search(frame).collect()] == [(0, 1, 2, 3.0), (0, 2, 1, 0.0)]


def test_hilbert_steps_are_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    order = cells[np.argsort(neighbours.hilbert(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_licenses(spark, nothing):
    rng = random.Random(1)
    def text(notice):
        return f"{prose(rng, 'en', 30)}\n{notice}\n{prose(rng, 'en', 30)}"

    rows = [(i, text(t)) for i, t in enumerate(licenses.TEMPLATES.values())]
    rows += [(50, text("Licensed under the Apache License, Version 1.1.")), (51, text("The license of this poet is wide.")), (52, None), (53, ""), (54, prose(rng, "en", 9000))]
    rows += [(0, rows[0][1])]
    found = licenses.scan(prepare(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    exact = {r.doc_id: r.license for r in found if r.wording == "exact"}
    assert exact == dict(enumerate(licenses.TEMPLATES))
    assert [(r.license, r.wording) for r in found if r.doc_id == 50] == [("Apache-2.0", "changed")]
    assert not {51, 52, 53, 54} & {r.doc_id for r in found}
    assert sum(r.doc_id == 0 for r in found) == 2
    assert licenses.scan(nothing).count() == 0


NOTICES = [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This file is distributed under the GNU General Public License v2.0"),
    ("GPL-1.0-or-later", "Released under the GNU GPL."),
    ("GPL-3.0", "// SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1 only"),
    ("AGPL-3.0", "The server is released under the GNU Affero General Public License v3.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "# SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", "It is available under the BSD 2-Clause License."),
    ("BSD-3-Clause", "It is available under the 3-Clause BSD License."),
    ("ISC", "Distributed under the ISC License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-SA-4.0", "The photographs are published under CC BY-NC-SA 4.0."),
    ("all-rights-reserved", "Copyright (c) 2021 Some Body. All rights reserved."),
]


def test_short_notices_of_every_license(spark):
    others = ["Released under the Zlib License.", "The MIT campus has a license to sell beer.", "She reserved all seats.", "Das ist mit der Lizenz gemeint."]
    rows = [(i, f"some words\n{notice}\nmore words") for i, notice in enumerate([n for _, n in NOTICES] + others)]
    found = licenses.scan(prepare(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.wording) for r in found) == [(i, name, "exact") for i, (name, _) in enumerate(NOTICES)]
    assert {name.removesuffix("-header") for name in licenses.TEMPLATES} <= {name for name, _ in licenses.WORDINGS}
    assert all(licenses.CUE.search(wording) for _, wording in licenses.WORDINGS if not wording.startswith(("or", "and")))


def test_notices_in_long_lines():
    """One line of any length, the notice at its start, in its middle and at its end; a cue in every line or none."""
    rng = random.Random(6)
    for size in (300, 4_000, 60_000):
        for around in (prose(rng, "en", size // 6), " ".join(["a license for all"] * (size // 18))):
            for name, wording in licenses.TEMPLATES.items():
                for at in (0, len(around) // 2, len(around)):
                    text = f"{around[:at]} {wording} {around[at:]}"
                    found = licenses.notices(text)
                    assert [(text[a:b].rstrip("."), n, d) for a, b, n, _, d, _ in found] == [(wording.rstrip(".:"), name, 0)], (size, name, at)


@pytest.mark.parametrize("prefix", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("width", [30, 72])
def test_wrapped_notices(prefix, width):
    """Every wording as it is wrapped in files, with blank lines around it and between sentences."""
    for name, wording in licenses.WORDINGS:
        if wording.startswith(("or", "and")):
            continue
        lines = textwrap.wrap(wording, width, break_on_hyphens=False, break_long_words=False)
        for text in ("\n".join(["int x;", "", *lines, "", "int y;"]), "\n\n".join(["a b c", *lines, "d e f"])):
            text = "\n".join(prefix + line for line in text.split("\n"))
            assert [(n, d) for _, _, n, _, d, _ in licenses.notices(text)] == [(name, 0)], text


def test_several_notices_in_a_text(spark):
    grants = dict((n, w) for n, w in licenses.WORDINGS[: len(licenses.TEMPLATES)])
    wrapped = {n: "\n".join(textwrap.wrap(w, 60)) for n, w in grants.items()}
    rng = random.Random(8)
    cases = [
        ("Licensed under the Apache License, Version 2.0 or the MIT License.", ["Apache-2.0", "MIT"]),
        (f"{wrapped['MIT']}\n{wrapped['GPL-3.0']}", ["MIT", "GPL-3.0"]),
        ("Copyright (c) 2020 A. All rights reserved.\n\n" + wrapped["BSD-3-Clause"], ["all-rights-reserved", "BSD-3-Clause"]),
        ("\n".join(wrapped.values()), list(wrapped)),  # more lines than any window
        ("\n".join(["Released under the MIT License."] * 300), ["MIT"] * 300),
        ("\n".join(f"Released under the MIT License.\n{prose(rng, 'en', k)}" for k in range(0, 400, 7)), ["MIT"] * 58),
    ]
    rows = [(i, text) for i, (text, _) in enumerate(cases)]
    found = {}
    for r in licenses.scan(prepare(spark).createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.wording == "exact"
        found.setdefault(r.doc_id, []).append((r.start, r.license))
    assert [[name for _, name in sorted(found[i])] for i in range(len(cases))] == [names for _, names in cases]


def test_winners_save_most():
    """Against all wordings: no wording saves more of a notice's bytes than the one that is reported, but for a byte or two."""
    plain, *dictionaries = (zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False),)
    for _, wording in licenses.WORDINGS:
        dictionary = zstandard.ZstdCompressionDict(" ".join(licenses._WORD.findall(wording.lower())).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionaries.append(zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=False, write_content_size=False))
    rng = random.Random(16)
    for name, wording in rng.sample(licenses.WORDINGS, 60):
        text = f"{prose(rng, 'en', 12)}\n{wording}\n{prose(rng, 'en', 12)}"
        ((start, end, found, share, different, _),) = licenses.notices(text)
        raw = " ".join(licenses._WORD.findall(text[start:end].lower())).encode()
        saved = [len(plain.compress(raw)) - len(tool.compress(raw)) for tool in dictionaries]
        own = max(s for s, (license_, _) in zip(saved, licenses.WORDINGS, strict=True) if license_ == found)
        assert (found, different) == (name, 0)
        assert own >= max(saved) - 2 and abs(share - own / len(plain.compress(raw))) < 1e-9 and share >= licenses.SAVED


def test_every_cue_has_a_stem():
    for _, wording in licenses.WORDINGS:
        for m in licenses.CUE.finditer(wording):
            assert any(s in m.group().lower() for s in licenses.STEMS) or any(s in m.group() for s in licenses.CAPITALS)


def test_line_field_of_repeated_labelled_rows(spark):
    """Thousands of copies of one good and one bad document, rows without an id: a field is fitted, from one row of each id."""
    rng = random.Random(31)
    good = "\n".join(prose(rng, "en", 14) + "." for _ in range(12))
    bad = "\n".join("$$ WIN NOW | BUY | #### !!!! 99% ***" for _ in range(12))
    rows = [(1, good)] * 2600 + [(2, bad)] * 2600 + [(None, good)] * 50
    frame = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (77, 0)] * 3, "doc_id long, quality int")
    field = quality.train(frame, labels)
    assert field is not None
    assert quality.judge(good, field)[-1] and not quality.judge(bad, field)[-1]


def test_line_field_marks_lines(spark):
    """Hand-labelled lines of documents that mix prose with boilerplate: states change within a document."""
    rng = random.Random(33)
    line = lambda: (prose(rng, "en", rng.randint(9, 16)) + ".").capitalize()
    junk = lambda: rng.choice(["HOME | NEWS | LOGIN | CART | HELP", "### $$$ 100% FREE!!! ### $$$", "1 2 3 4 5 6 7 8 9 10 >> <<", "A | B | C | D | E | F"])
    rows = [(i, "\n".join(line() for _ in range(rng.randint(3, 30)))) for i in range(60)]
    rows += [(100 + i, "\n".join(junk() for _ in range(rng.randint(3, 30)))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
    field = quality.train(prepare(spark).createDataFrame(rows, "doc_id long, text string"), labels)
    stay, leave = np.diag(field.transition), field.transition[[0, 1], [1, 0]]
    assert (stay > leave).all()  # states last, and yet
    right = total = 0
    for _ in range(40):
        states = [s for _ in range(3) for s in [rng.randint(0, 1)] * rng.randint(2, 6)]
        lines = [(junk() if s else line()).encode() for s in states]
        found = quality.viterbi(np.array([quality.line_features(one)[0] for one in lines]), field)
        right, total = right + int((found == states).sum()), total + len(states)
        share = quality.judge(b"\n".join(lines).decode(), field)[6]
        assert 0 < share < 1 or len(set(states)) == 1
    assert right >= 0.95 * total


def test_stretches_are_spread_over_a_text():
    text = "\n".join(f"line {i} " + "x" * (i % 7) for i in range(1000))
    parts = quality.stretches(text)
    whole = np.array([quality.line_features(one)[0] for one in text.encode().split(b"\n")])
    assert [len(p) for p in parts] == [16, 16, 16, 8]
    assert (parts[0] == whole[:16]).all() and (parts[-1] == whole[992:]).all()
    assert sum(map(len, quality.stretches("\n".join("ab" for _ in range(50))))) == 50


def test_language_sample_of_repeated_rows(spark):
    """NULL ids and copies: what meets in a language's group is bounded by the sample, whatever the number of rows."""
    rng = random.Random(35)
    same = [(None, "abcdefgh " * 20, "en")] * 3000 + [(5, prose(rng, "xx", 40), "xx")] * 500
    same += [(None, prose(rng, lang, 30)[:150], lang) for lang in ("en", "xx") for _ in range(300)]
    learn = prepare(spark).createDataFrame(same, "doc_id long, text string, lang string").repartition(6)
    limits = language.smallest(learn.select("lang", F.xxhash64("doc_id", "text").alias("h")), 50)
    kept = learn.withColumn("h", F.xxhash64("doc_id", "text")).filter("text is not null")
    for lang, limit in limits.items():
        assert kept.filter((F.col("lang") == lang) & (F.col("h") <= limit)).select("h").distinct().count() == 50
    model = language.train(learn, per_language=50, clusters=3)
    tests = [(i, prose(rng, lang, 40), lang) for i, lang in enumerate(["en", "xx"] * 20)]
    assert all(language.classify(text, model)[0] == lang for _, text, lang in tests)
