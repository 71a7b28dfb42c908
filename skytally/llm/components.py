"""Connected components by contraction: every node joins its smallest neighbour, joined nodes become one, and again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.session import stage

#: Rounds after which the nodes are put into another random order.
REORDER = 4


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of the edges ``a``, ``b`` (long, not NULL).

    Nodes are compared by a hash, so the number of nodes shrinks by a constant share in a round whatever the ids are;
    a chain of n documents takes O(log n) rounds. Neighbours are folded by a minimum, never listed, so a node may have
    any number of them. Each round is written to the shared folder. An edge from a node to itself makes a component.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b"))
    level = stage(_between(edges), "edges")
    maps: list[DataFrame] = []
    while not level.isEmpty():
        place = lambda c, n=len(maps) // REORDER: F.xxhash64(F.col(c), F.lit(n))
        both = level.select("a", "b").union(level.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min(F.struct(place("b").alias("h"), F.col("b"))).alias("m"))
        own = F.struct(place("a").alias("h"), F.col("a").alias("b"))
        step = stage(nearest.select(F.col("a").alias("node"), F.least(own, F.col("m"))["b"].alias("rep")), "contraction")
        maps.append(step)
        ends = level.join(step.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a")
        ends = ends.join(step.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b")
        level = stage(_between(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "edges")
    total = nodes.distinct().withColumn("rep", F.col("node"))
    for step in maps:
        further = step.select(F.col("node").alias("rep"), F.col("rep").alias("next"))
        total = total.join(further, "rep", "left").select("node", F.coalesce("next", "rep").alias("rep"))
    total = stage(total, "representatives")
    smallest = total.groupBy("rep").agg(F.min("node").alias("component"))
    return total.join(smallest, "rep").select("node", "component")


def _between(edges: DataFrame) -> DataFrame:
    """Distinct edges between different nodes, the smaller first."""
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct()
