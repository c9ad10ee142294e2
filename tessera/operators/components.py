"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stash, unstash


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges``; root: the smallest node of its component.

    Self loops and repeated edges are allowed; null ends are ignored.  A step groups with a partial minimum and
    joins back, so a node with very many edges is split like any skewed join; ``rounds`` far exceeds the
    logarithm of any graph's size, and not converging within it is an error.
    """
    both = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = both.select("a").union(both.select("b")).distinct().withColumnRenamed("a", "node")
    pairs = stash(both.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_of = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    state = pairs.agg(F.count(F.lit(1)), print_of).first()
    for _ in range(rounds):
        if not state[0]:
            break
        sides = pairs.union(pairs.select("b", "a"))
        least = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = sides.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("x"), "m").filter("x <> m").union(least.select("a", "m"))
        following = stash(small.select(F.col("x").alias("a"), F.col("m").alias("b")).distinct())
        now = following.agg(F.count(F.lit(1)), print_of).first()
        unstash(pairs)
        pairs, done, state = following, tuple(now) == tuple(state), now
        if done:
            break
    else:
        raise RuntimeError(f"components did not converge in {rounds} rounds")
    return nodes.join(pairs.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("root"))
