"""Connected components of a graph given as a table of edges, by alternating large-star and small-star
rounds. Each round is a few aggregations and joins over tables of edges; the number of rounds grows
with the logarithm of the longest path, and no node's neighbours are ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written


def _stars(edges: DataFrame) -> bool:
    """Whether every node has either larger neighbours only or one smaller neighbour only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger"))
    )
    both = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return both.filter("smaller + larger > 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node that can be reached.

    Edges have no direction; loops, repeated edges and edges with a null end change nothing.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a), F.col(b))
    pair = pair.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    now = written(pair.select("u", "v").distinct(), "component-edges")
    while not _stars(now):
        # Large star: every larger neighbour of a node goes to the smallest node around it.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "component-lowest")
        larger = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(larger.distinct(), "component-large")
        # Small star: the smaller neighbours of a node, and the node, go to the smallest of them.
        lowest = written(large.groupBy("u").agg(F.min("v").alias("m")), "component-lowest")
        smaller = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(smaller.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "component-edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
