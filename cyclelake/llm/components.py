"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import staged


LARGE = 1_000_000   # edges from which a node may have too many of them for one task


def _point_to_least(edges: DataFrame, own: bool, large: bool) -> DataFrame:
    """Every edge (u, v) with the least neighbour of u as ``m`` (u itself counts when ``own``). With many edges the least
    neighbours are written first, so that the join is one of two plain tables and a node with very many links is split."""
    least = F.least(F.min("v"), F.col("u")) if own else F.min("v")
    table = edges.groupBy("u").agg(least.alias("m"))
    return edges.join(staged(table, "least") if large else table, "u")


def components(links: DataFrame, a="a", b="b") -> DataFrame:
    """(node, component): the smallest node that each linked node can reach. Nodes without links do not appear; null ends
    and self links say nothing; an empty table gives an empty one.

    Large-star and small-star steps in turn: each node's larger neighbours, then its smaller ones, are pointed to its least
    neighbour, until nothing changes. The number of rounds grows with the logarithm of the longest path.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = staged(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "edges")

    def mark(df):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(edges)
    while seen[0]:
        many = seen[0] >= LARGE
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _point_to_least(both, True, many).filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        pointed = _point_to_least(staged(large, "edges") if many else large, False, many)
        # An edge to another than the least neighbour also ties that neighbour to the least one.
        both_ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = pointed.select(F.inline(both_ends)).filter(F.col("u") != F.col("v"))
        edges = staged(small.distinct(), "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
