"""Connected components by alternating large and small stars, each round a few shuffles of the remaining links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal for equal edge sets."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) links; root is the smallest node of its component.

    A node's smallest neighbour is found by an aggregate and joined back, so
    the neighbours of a node are never gathered in one row.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that Spark can split the links of a node with very many neighbours in the joins
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = written(large.groupBy("u").agg(F.min("v").alias("m")), "links-small")
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = written(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        last, state = state, _state(edges)
        if state == last:
            roots = edges.select("v").distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
