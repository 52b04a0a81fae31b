"""Connected components of a distributed edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.session import materialise

#: Each pair of stars at least halves the distance to the root, so this is far beyond any real graph.
MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_least(edges: DataFrame) -> DataFrame:
    """Edges (b, least neighbour of a or a itself); the least is one row per node, its count partial."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_least"))
    return edges.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    joined = _to_least(_both_ways(edges)).where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    joined = _to_least(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    moved = joined.where("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.unionByName(joined.select("a", F.col("_least").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (columns ``a`` and ``b``): root is the least node reachable.

    Self loops, repeated edges and nulls are ignored; no edge gives no row.  Each
    round is written to the shared folder, so a lost executor costs a round at
    most.  A node with very many edges meets one row of its least neighbour, a
    join that adaptive execution splits.
    """
    now = materialise(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = _digest(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        now = materialise(_small_star(_large_star(now)), "edges")
        digest = _digest(now)
        if digest == seen:
            break
        seen = digest
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
