"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import scratch


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` ``(a, b)``, where ``root`` is the least node it is connected with.

    Every round links each node's larger neighbours to its least one, then its smaller ones. Both are
    aggregations and joins on a node, whose hot side Spark can split; the rounds grow with the logarithm
    of the longest path. A loop ``(a, a)`` names a node without neighbours. Edges may repeat.
    """
    edges = scratch(edges.select("a", "b"), "edges")
    now = edges.where("a <> b")
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.expr("if(b = m, a, b)").alias("a"), F.col("m").alias("b"))
        now = scratch(small.distinct(), "small-star")
        if not _tangled(now):
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = now.select("b").union(edges.where("a = b").select("a"))
    return roots.union(own.select("b", "b")).groupBy("node").agg(F.min("root").alias("root"))


def _tangled(edges: DataFrame) -> int:
    """How many nodes of ``edges`` from larger to least have two of these, or one while being one themselves."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = up.union(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").count()
