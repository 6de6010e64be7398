"""The registered queries of the operators, each over its whole table with the operator's own defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import (
    divergence,
    fingerprints,
    language,
    licenses,
    likelihood,
    manifest,
    near_duplicates,
    neighbours,
    packing,
    pieces,
    quality,
    repeats,
    token_counts,
)
from tillhouse.llm.common import remainder, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build):
    REGISTRY[build.__name__] = build
    return build


@query
def op1_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 3) == 1
    model = language.train(documents.filter(~held_out).select("doc_id", "text", "lang"))
    return language.identify(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_near_duplicates(spark, sf_dir):
    return near_duplicates.link(table(spark, sf_dir, "documents"), width=3, percent=85)


# Links by shared shingles, then everything reachable over them.
ORACLE_SQL["op2_near_duplicates"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.both >= 85 * (x.n + y.n - p.both)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM w
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op5_piece_encoding(spark, sf_dir):
    return pieces.encode_and_decode(table(spark, sf_dir, "documents"))


@query
def op6_hilbert_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op7_lattice_likelihood(spark, sf_dir):
    return likelihood.score(table(spark, sf_dir, "documents"))


@query
def op8_sequence_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_repeated_passages(spark, sf_dir):
    return repeats.remove(table(spark, sf_dir, "documents"))


@query
def op10_line_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.assess(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query
def op11_improbable_features(spark, sf_dir):
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


@query
def op12_merkle_log(spark, sf_dir):
    return manifest.audit(table(spark, sf_dir, "documents"))


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def _merkle_sql() -> str:
    """Eight levels of each kind of tree, enough for 16 million leaves; trees that have ended pass their node on."""
    values = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}")]
    leaf = f"sha256({' || '.join(values)})"
    text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    divide = "xor(c // 2, 3988292384 * (c % 2))"
    parts = [
        f"""crc0 AS (SELECT i, i AS c FROM range(256) t(i))""",
        *[f"crc{k} AS (SELECT i, {divide} AS c FROM crc{k - 1})" for k in range(1, 9)],
        "crc AS (SELECT list(c ORDER BY i) AS t FROM crc8)",
        f"""leaves AS (
    SELECT doc_id, lang, {leaf.format(text="text")} AS leaf, CASE WHEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1]))) % 3 = 0 THEN {leaf.format(text=text)} END AS changed FROM documents, crc
)""",
        """a0 AS (SELECT lang AS k, leaf AS h, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, doc_id, changed FROM leaves)""",
        "f0 AS (SELECT k, i, doc_id, h AS leaf, coalesce(changed, h) AS v, '' AS p FROM a0)",
        "n0 AS (SELECT k, h, i FROM a0)",
    ]
    step = """f{b} AS (
    SELECT k, i // 8 AS i, doc_id, leaf, {keep} CASE WHEN n > 1 THEN sha256(coalesce(l, '') || v || coalesce(r, '')) ELSE v END AS v,
        CASE WHEN n > 1 THEN p || coalesce(l, '') || coalesce(r, '') ELSE p END AS p
    FROM (SELECT f.*, (SELECT string_agg(h, '' ORDER BY n.i) FROM n{a} n WHERE n.k IS NOT DISTINCT FROM f.k AND n.i // 8 = f.i // 8 AND n.i < f.i) AS l,
        (SELECT string_agg(h, '' ORDER BY n.i) FROM n{a} n WHERE n.k IS NOT DISTINCT FROM f.k AND n.i // 8 = f.i // 8 AND n.i > f.i) AS r,
        (SELECT count(*) FROM n{a} n WHERE n.k IS NOT DISTINCT FROM f.k) AS n FROM f{a} f)
)"""
    grow = """n{b} AS (
    SELECT k, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, i // 8 AS i
    FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM n{a}) GROUP BY k, i // 8
)"""
    for a in range(8):
        parts += [grow.format(a=a, b=a + 1), step.format(a=a, b=a + 1, keep="")]
    parts += [
        "n9 AS (SELECT 0 AS k, h, row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS i, k AS of FROM n8)",
        "f9 AS (SELECT n9.k, n9.i, doc_id, leaf, n9.h AS subroot, v, p FROM f8 JOIN n9 ON n9.of IS NOT DISTINCT FROM f8.k)",
    ]
    for a in range(9, 17):
        parts += [grow.format(a=a, b=a + 1), step.format(a=a, b=a + 1, keep="subroot,")]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, n17.h AS root, sha256(p) AS proof_sha256, v AS folded_root, v = n17.h AS verified FROM f17, n17"""


ORACLE_SQL["op12_merkle_log"] = _merkle_sql()

# Every group times every kept term, then all pairs of groups.
ORACLE_SQL["op13_source_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
s AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
n AS (SELECT lang, source, sum(c) AS n FROM s GROUP BY lang, source),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(s.c, 0) AS c,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(s.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v) AS p,
        1 + (CAST(1000000000 AS HUGEINT) * (k.c + 2)) // (v.n + 2 * v.v) AS q
    FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang
    LEFT JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
), f AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) WHERE part = 'pair' OR rank <= 10"""
