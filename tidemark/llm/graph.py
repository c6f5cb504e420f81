"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) but the roots: root is the smallest node that can be reached.

    Each round hangs a node's larger neighbours, then its smaller ones, under the smallest neighbour; the rounds grow
    with the logarithm of the longest chain. A node of very many edges is one row on one side of each join.
    """
    a, b = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    tree = scratch.table(edges.filter("a <> b").select(a, b).distinct())
    before = None
    while True:
        state = tree.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first()
        if state == before:
            return tree.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = tree.unionByName(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = scratch.table(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tree = scratch.table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
