"""Connected components of a large graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import stored


def _open(edges: DataFrame) -> bool:
    """Whether some node of (a, b), a > b, has two smaller neighbours, or one and a larger one."""
    roles = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")),
                                           F.struct(F.col("b").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs")))).alias("r"))
    nodes = roles.groupBy("r.node").agg(F.sum("r.ups").alias("ups"), F.max("r.downs").alias("downs"))
    return nodes.filter("ups > 1 OR ups = 1 AND downs = 1").agg(F.count("*")).first()[0] > 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``: the smallest node reachable.

    Each round points a node's larger neighbours, then a node and its smaller ones, to
    the smallest neighbour, until each node is the centre or a leaf of one star. Rounds
    grow with the logarithm of the graph's size. Only a count reaches the driver; each
    round is one written table, so a lost executor costs one round at most. A self link
    or a null end gives no node.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    edges = stored(links.filter(F.col(a) != F.col(b)).select(hi.alias("a"), lo.alias("b")).distinct(), "links")
    while _open(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a != b").distinct())
        edges = stored(small, "stars")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
