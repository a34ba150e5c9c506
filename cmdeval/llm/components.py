"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MAX_ROUNDS = 50


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) from (a, b): the smallest node that links lead to, for every node of an edge.

    Alternating stars: each node hangs its larger neighbours under its smallest
    neighbour, then itself and its smaller neighbours likewise, until every
    component is one star. The smallest neighbour is a map-side combined
    minimum, so a hub with a third of all edges costs one number a task; the
    join back on the hub splits by adaptive execution. Each round ends in files
    of the shared folder. The rounds grow with the logarithm of the longest path.
    """
    links = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                        f"{name}-links")

    def sign(df: DataFrame) -> tuple:
        # Which links there are, in two numbers: the rounds end when they stay the same.
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = sign(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        under = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(under, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(under.select("a", F.col("m").alias("b"))))
        links = materialise(small.distinct(), f"{name}-links")
        now = sign(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
