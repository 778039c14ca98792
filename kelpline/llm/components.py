"""Connected components of a graph in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.tables import fitted

#: Pointer jumps in a round; each doubles the length of path that a round contracts.
JUMPS = 2
def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``node, component``: the least node that can be reached, for every node of an edge.

    A round lets every node point to its least neighbour, jumps along these pointers, and
    contracts the graph; what is left of it shrinks by a constant factor at least, and every round is
    staged, so that a lost executor costs one round. Small graphs are one partition and shuffle nothing.
    """
    left = fitted(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = fitted(nodes.withColumn("component", F.col("node")))
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        points = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("x"), F.least("a", "b").alias("y"))
        for _ in range(JUMPS):
            onward = points.select(F.col("x").alias("y"), F.col("y").alias("_z"))
            points = points.join(onward, "y").select("x", F.col("_z").alias("y"))
        points = fitted(points)
        of = lambda c: points.select(F.col("x").alias(c), F.col("y").alias(f"_{c}"))
        labels = labels.join(of("component"), "component", "left").select("node", F.coalesce("_component", "component").alias("component"))
        contracted = left.join(of("a"), "a").join(of("b"), "b").where("_a <> _b")
        left = fitted(contracted.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
        labels = fitted(labels)
    return labels


def joined_by(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Components ``labels(node, component)`` after more ``edges(a, b)``: only the edges between components count."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
    ends = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = ends.select("a", "b", F.coalesce("_a", "a").alias("x"), F.coalesce("_b", "b").alias("y"))
    above = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("_top"))
    nodes = ends.select(F.col("a").alias("node"), F.col("x").alias("component")).union(ends.select("b", "y")).union(labels).distinct()
    return fitted(nodes.join(above, "component", "left").select("node", F.coalesce("_top", "component").alias("component")))
