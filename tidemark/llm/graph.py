"""Connected components of a distributed edge table (distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (columns a, b): root is the smallest node it can reach.

    Alternating large-star and small-star contraction (Kiveris et al., 2014): each round is two aggregations and
    two joins on nodes, and the edge table never grows. Minima are combined before the shuffle, and the join
    leaves a node with very many edges to be split by adaptive execution. Every round is written to the shared
    folder. Loops, repeated edges and edges with a null are ignored; an empty table gives an empty one.
    """
    current = cut(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        stars = cut(_small_star(_large_star(current)), "stars")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        current = stars
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    leaves = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return leaves.unionAll(leaves.select("root", "root").distinct())


def _linked_to_least(both: DataFrame) -> DataFrame:
    """(u, v, m) for each row (u, v) of ``both``, with m the least of u and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _linked_to_least(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    linked = _linked_to_least(down)
    return linked.select(F.col("m").alias("a"), F.col("v").alias("b")).unionAll(linked.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b").distinct()
