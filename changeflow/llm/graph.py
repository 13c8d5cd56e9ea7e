"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b) with a > b.

    Large: every neighbour above a node is linked to the least of the node and its neighbours. Small: every
    neighbour below a node, and the node, are linked to the least of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("_a", "m").alias("_m"))
    met = both.join(least, F.col("a") == F.col("_a"))
    if large:
        new = met.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        new = met.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            least.select(F.col("_a").alias("a"), F.col("_m").alias("b"))
        )
    return new.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _print(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); the component is its least node.

    Rounds grow with the logarithm of the number of nodes. A hub's edges are spread by join, never held together.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(now, "edges")
    seen = _print(now)
    while seen[0]:
        now = stage(_star(_star(now, True), False), "edges")
        found = _print(now)
        if found == seen:
            break
        seen = found
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component")).distinct()
