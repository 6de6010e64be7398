"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of every node on an edge (a, b).

    Alternates two steps until nothing changes: every node hands its larger neighbours (first step) or its smaller
    ones (second step) to its smallest neighbour. Each step sums up per node before the shuffle and joins with a
    stored table, so a node with very many neighbours is split over tasks. Rounds grow with the logarithm of the
    longest path. Self-loops are allowed; an empty table gives an empty result.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        larger = _star(edges, both=True)
        smaller = _star(larger, both=False)
        smaller = stored(smaller.distinct(), "edges")
        if _print(smaller) == _print(edges):
            break
        edges = smaller
    # every node now has one edge, to its root
    found = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def _print(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, whichever end comes first."""
    pair = F.xxhash64(F.greatest("a", "b"), F.least("a", "b"))
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(pair), F.sum(F.shiftright(pair, 20))).first())


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Connect each node's neighbours to the smallest of them and the node.

    both: look at all neighbours and hand over the larger ones; else look at the smaller ones and hand over these.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    directed = edges.select(high.alias("node"), low.alias("next"))
    if both:
        directed = directed.unionByName(edges.select(low.alias("node"), high.alias("next")))
    least = stored(directed.groupBy("node").agg(F.min("next").alias("least")).select("node", F.least("node", "least").alias("least")), "least")
    joined = directed.join(least, "node")
    if both:
        return joined.filter("next > node").select(F.col("next").alias("a"), F.col("least").alias("b")).filter("a <> b")
    handed = joined.select(F.col("next").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return handed.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).filter("a <> b")
