"""A Merkle manifest of a dataset, kept as a log of tree nodes in the order in which they are completed.

Rows are leaves. Each language has a tree of them by id, in which every ARITY consecutive nodes have a parent (the last
parent may have fewer, even one), up to a single node; the trees' roots, by language, are the leaves of one more tree.

The log of a tree is its nodes in postorder: a node is appended as soon as its last leaf is there. Before leaf e come
e leaves and, for each level k, e // ARITY**k nodes, so that a node of level L whose last leaf is e has the place
e + sum(e // ARITY**k) + L, whoever writes it. Builders own aligned blocks of ARITY**LEVELS leaves. The nodes of
a block are a stretch of the log that the builder writes on its own, from a stack of unfinished runs; the tops of the blocks are
the leaves of the next round of builders. Proofs are taken from the log in the opposite direction: the block gets its stretch
and the way from its top to the root, and finds the siblings of a leaf at the places that the formula gives.

Defined results: leaves go by id, NULL first, then by digest; repeated rows are leaves of their own. NULL values are
written '-', hence differ from empty texts. Rows without an id are not tampered with. Texts of any length are hashed by the JVM.
An empty table gives an empty log and no proofs. Columns other than the five that are hashed take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ranked, stored

ARITY = 8
#: Levels of a builder's block, hence ARITY**LEVELS leaves of it.
LEVELS = 4
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LOG = "lang string, level int, place long, digest binary, top boolean, node long, total long"
PATH = "array<struct<left:string,right:string>>"
ROWS = f"lang string, block long, role int, place long, digest binary, total long, doc_id long, changed binary, path {PATH}, subroot binary, root binary"


def hashed(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()


def place(level: int, node: int, total: int) -> int:
    """Where the log of a tree with that many leaves has the node."""
    last = min((node + 1) * ARITY**level, total) - 1
    at, rest = last + level, last
    while rest:
        rest //= ARITY
        at += rest
    return at


def height(total: int) -> int:
    """Levels above the leaves."""
    level = 0
    while ARITY**level < total:
        level += 1
    return level


def nodes_at(level: int, total: int) -> int:
    return -(-total // ARITY**level)


def digest(text: Column) -> Column:
    """The digest of a row: each value with its length in bytes."""
    values = [F.col(c).cast("string") if c != "text" else text for c in COLUMNS]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(documents: DataFrame) -> DataFrame:
    """doc_id, lang, digest, and the digest after tampering where a row is tampered with."""
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 0
    changed = F.when(tampered, digest(F.translate("text", CAPITALS, CAPITALS.lower())))
    return documents.select("doc_id", F.col("lang").cast("string").alias("lang"), digest(F.col("text")).alias("digest"), changed.alias("changed"))


def completed(start: int, digests: list[bytes], base: int, total: int, levels: int = LEVELS) -> Iterator[tuple[int, int, bytes]]:
    """(level, node, digest) of a block's nodes in the order of their completion.

    digests: the block's nodes of level base, the first of which is node start; total: all leaves of the tree.
    """
    most = min(base + levels, max(base, height(total)))
    held: list[list[str]] = [[] for _ in range(levels + 1)]
    ends = nodes_at(base, total) - 1
    for i, value in enumerate(digests, start):
        level, node = base, i
        while True:
            if level > base or not base:  # the leaves of later rounds are in the log already
                yield level, node, value
            if level == most:
                break
            run = held[level - base]
            run.append(value.hex())
            if len(run) < ARITY and i != ends:
                break
            value = hashlib.sha256("".join(run).encode()).digest()
            run.clear()
            level, node = level + 1, node // ARITY


def _grow(nodes: DataFrame, base: int, levels: int) -> DataFrame:
    """The part of the log that one round of builders writes. nodes: lang, node, digest, total of level base."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        lang, total, start = (table.column(c)[0].as_py() for c in ("lang", "total", "node"))
        rows = list(completed(start, table.column("digest").to_pylist(), base, total, levels))
        top = height(total)
        return pa.table(
            {
                "lang": pa.array([lang] * len(rows), pa.string()),
                "level": pa.array([level for level, _, _ in rows], pa.int32()),
                "place": pa.array([place(level, node, total) for level, node, _ in rows], pa.int64()),
                "digest": pa.array([value for _, _, value in rows], pa.binary()),
                "top": pa.array([level == top for level, _, _ in rows], pa.bool_()),
                "node": pa.array([node for _, node, _ in rows], pa.int64()),
                "total": pa.array([total] * len(rows), pa.int64()),
            }
        )

    block = F.floor(F.col("node") / ARITY**levels).alias("block")
    return stored(nodes.groupBy("lang", block).applyInArrow(build, LOG), "log")


def grow(entries: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The log of every tree, one table for each round. entries: lang, rank, total, digest of all leaves."""
    most = entries.agg(F.max("total")).first()[0] or 0
    nodes = entries.select("lang", F.col("rank").alias("node"), "digest", "total")
    log = [_grow(nodes, 0, levels)]
    while ARITY ** (base := len(log) * levels) < most:
        tops = log[-1].filter((F.col("level") == base) & ~F.col("top"))
        log.append(_grow(tops.select("lang", "node", "digest", "total"), base, levels))
    return log


def roots(log: list[DataFrame]) -> DataFrame:
    """lang and subroot of every tree."""
    found = log[0]
    for part in log[1:]:
        found = found.unionByName(part)
    return found.filter("top").select("lang", F.col("digest").alias("subroot"))


class Stretch:
    """A block's entries of the log, by place, and the way from the block's top to the root."""

    def __init__(self, block: int, base: int, levels: int, total: int, log: dict[int, bytes], path: list[tuple[str, str]]):
        self.base, self.total, self.log = base, total, log
        self.ways = {(min(base + levels, max(base, height(total))), block): path}

    def node(self, level: int, node: int) -> bytes:
        return self.log[place(level, node, self.total)]

    def way(self, level: int, node: int) -> list[tuple[str, str]]:
        """Siblings on the left and on the right, from the node's own level up."""
        if (level, node) not in self.ways:
            parent = node // ARITY
            ends = min((parent + 1) * ARITY, nodes_at(level, self.total))
            near = [self.node(level, i).hex() for i in range(parent * ARITY, ends)]
            own = node - parent * ARITY
            way = [("".join(near[:own]), "".join(near[own + 1 :])), *self.way(level + 1, parent)]
            if level == self.base:
                return way
            self.ways[level, node] = way
        return self.ways[level, node]


def folded(leaf: bytes, way: list[tuple[str, str]]) -> str:
    value = leaf.hex()
    for left, right in way:
        value = hashed(f"{left}{value}{right}".encode())
    return value


def _in_blocks(log: list[DataFrame], above: DataFrame, asked: DataFrame | None, round_: int, levels: int) -> DataFrame:
    """What the blocks of a round need, as rows of one kind: their way up, their part of the log, the leaves asked for."""
    base, size = round_ * levels, ARITY**levels
    entries = log[round_]
    if round_:
        entries = entries.unionByName(log[round_ - 1].filter((F.col("level") == base) & ~F.col("top")))
    width = F.pow(F.lit(ARITY), F.lit(base + levels) - F.col("level"))
    entries = entries.withColumn("block", F.floor(F.col("node") / width).cast("long"))
    kinds = dict(part.split(" ", 1) for part in ROWS.split(", "))

    def full(df: DataFrame, role: int) -> DataFrame:
        missing = {c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns}
        return df.withColumns(missing | {"role": F.lit(role)}).select(*kinds)

    rows = full(above, 0).unionByName(full(entries, 1))
    if asked is not None:
        asked = asked.select("lang", "doc_id", "changed", "total", F.col("rank").alias("place"), F.floor(F.col("rank") / size).cast("long").alias("block"))
        rows = rows.unionByName(full(asked, 2))
    return rows


def _stretch(table: pa.Table, base: int, levels: int) -> tuple[Stretch, pa.Table, dict]:
    role = table.column("role").to_numpy()
    head = table.filter(pa.array(role == 0)).to_pylist()[0]
    entries = table.filter(pa.array(role == 1))
    log = dict(zip(*(entries.column(c).to_pylist() for c in ("place", "digest")), strict=True))
    path = [(step["left"], step["right"]) for step in head["path"]]
    total = entries.column("total")[0].as_py()
    return Stretch(head["block"], base, levels, total, log, path), table.filter(pa.array(role == 2)), head


def _ways(log: list[DataFrame], above: DataFrame, round_: int, levels: int) -> DataFrame:
    """The way up from every node of level base, which is the top of a block of the round before."""
    base = round_ * levels

    def run(table: pa.Table) -> pa.Table:
        stretch, _, head = _stretch(table, base, levels)
        start = head["block"] * ARITY**levels
        nodes = range(start, min(start + ARITY**levels, nodes_at(base, stretch.total)))
        out = [
            {k: head[k] for k in ("lang", "subroot", "root")}
            | {"block": node, "path": [{"left": a, "right": b} for a, b in stretch.way(base, node)]}
            for node in nodes
        ]
        return pa.Table.from_pylist(out, schema=_ARROW_WAYS)

    return stored(_in_blocks(log, above, None, round_, levels).groupBy("lang", "block").applyInArrow(run, _WAYS), "ways")


_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_WAYS = f"lang string, block long, path {PATH}, subroot binary, root binary"
_ARROW_WAYS = pa.schema([("lang", pa.string()), ("block", pa.int64()), ("path", _STEPS), ("subroot", pa.binary()), ("root", pa.binary())])
_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(log: list[DataFrame], above: DataFrame, entries: DataFrame, levels: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        stretch, asked, head = _stretch(table, 0, levels)
        subroot, root = head["subroot"].hex(), head["root"].hex()
        out: dict[str, list] = {part.split()[0]: [] for part in _PROOFS.split(", ")}
        for doc_id, rank, changed in zip(*(asked.column(c).to_pylist() for c in ("doc_id", "place", "changed")), strict=True):
            leaf, way = stretch.node(0, rank), stretch.way(0, rank)
            found = folded(changed or leaf, way)
            proof = hashed("".join(left + right for left, right in way).encode())
            for column, value in zip(out, (doc_id, leaf.hex(), subroot, root, proof, found, found == root), strict=True):
                out[column].append(value)
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        return pa.table({c: pa.array(values, kind) for (c, values), kind in zip(out.items(), kinds, strict=True)})

    return _in_blocks(log, above, entries, 0, levels).groupBy("lang", "block").applyInArrow(run, _PROOFS)


def prove(entries: DataFrame, log: list[DataFrame], ways: DataFrame, levels: int = LEVELS) -> DataFrame:
    """A proof of every leaf, from the log. ways: lang, total, path from the subroot up, subroot, root."""
    above = None
    for round_ in reversed(range(len(log))):
        base = round_ * levels
        # here the trees come in whose nodes of this level make one block
        alone = F.col("total") <= ARITY ** (base + levels)
        alone &= F.lit(True) if not base else F.col("total") > ARITY**base
        heads = ways.filter(alone).select("lang", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        above = heads if above is None else heads.unionByName(above)
        if round_:
            above = _ways(log, above, round_, levels)
    return _proofs(log, above, entries, levels)


def manifest(documents: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Ranked leaves, the log of every tree, and for each tree its total, subroot and way to the root.

    The log is stored; it is all that a proof needs beside the leaf it is for.
    """
    entries = ranked(leaves(documents), ["lang"], ["doc_id", "digest"], "leaves")
    entries = stored(entries, "entries")
    log = grow(entries, levels)
    totals = entries.groupBy("lang").agg(F.first("total").alias("total"))
    subroots = roots(log)

    # the tree over the trees: its leaves are known by their rank among the languages
    crowns = ranked(subroots, [], ["lang"], "subroots")
    crowns = stored(crowns.select(F.lit(None).cast("string").alias("lang"), "rank", "total", F.col("subroot").alias("digest"), F.col("lang").alias("of")), "crowns")
    crown = grow(crowns, levels)
    root = roots(crown).select(F.col("subroot").alias("root"))
    above = root.selectExpr("cast(null as string) AS lang", "0L AS block", f"cast(array() AS {PATH}) AS path", "root AS subroot", "root")
    for round_ in reversed(range(len(crown))):
        above = _ways(crown, above, round_, levels)
    ways = crowns.select(F.col("of").alias("lang"), "rank", F.col("digest").alias("subroot")).join(
        above.select(F.col("block").alias("rank"), "path", "root"), "rank"
    )
    named = totals.withColumnRenamed("lang", "of")
    ways = ways.join(named, F.col("lang").eqNullSafe(F.col("of"))).select("lang", "total", "path", "subroot", "root")
    return entries, log, stored(ways, "trees")


def audit(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    entries, log, ways = manifest(documents, levels)
    return prove(entries, log, ways, levels)
