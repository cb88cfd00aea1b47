"""Connected components of a graph given as an edge table, by alternating stars.

A large-star step links every neighbour above a node to the smallest node of
its neighbourhood; a small-star step does the same for the neighbours below.
Both are one grouped minimum (summed map-side, so a node with a third of all
edges is no task's burden) and one equi-join of the edges with those minima,
whose hot partitions Spark splits.  The edges shrink to one star per
component in a number of rounds that grows with the logarithm of the longest
path.  Every round is a written table, so nothing reaches the driver but two
numbers and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexaccess.llm.common import stage_table


def _with_minimum(edges: DataFrame) -> DataFrame:
    """(u, v, m): m the smallest of u and its neighbours v in ``edges``."""
    least = edges.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_minimum(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point down (u > v): u and all its v get the smallest v."""
    least = _with_minimum(edges)
    return (least.select("u", F.col("m").alias("v"))
            .union(least.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge of ``edges`` (u, v); component: its smallest node.

    Loops and repeated edges do no harm; nodes may be of any orderable type but
    not null.  A node whose only edges are loops is left out, like any other
    node without a link: it is its own component.
    """
    down = (edges.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = stage_table(down, "cc")
    state = _state(now)
    while state[0]:
        after = stage_table(_small_star(_large_star(now)), "cc")
        new = _state(after)
        if new == state:
            break
        now, state = after, new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
