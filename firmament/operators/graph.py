"""Iterative graph jobs on narrow DataFrames: pointer chasing and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.session import stored


def chase_pointers(pointers: DataFrame) -> DataFrame:
    """Follow ``parent`` links until every node knows its root.

    ``pointers(node, root, parent)``: exactly one of root and parent is set, the links
    hold no cycle and the table is materialised.  Each round halves the longest path that
    is left.  Returns ``(node, root)``.
    """
    state = pointers
    while True:
        waiting = state.filter(F.col("root").isNull())
        if waiting.isEmpty():
            return state.select("node", "root")
        above = state.select(
            F.col("node").alias("parent"),
            F.col("root").alias("next_root"),
            F.col("parent").alias("next_parent"),
        )
        moved = waiting.join(above, "parent").select(
            "node",
            F.col("next_root").alias("root"),
            F.when(F.col("next_root").isNull(), F.col("next_parent")).alias("parent"),
        )
        state = stored(state.filter(F.col("root").isNotNull()).unionByName(moved))


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node id of every component: ``(node, component)`` for nodes with an edge.

    Each round replaces the edges (a > b) in two steps.  First every neighbour that
    is larger than a node is linked to the smallest node of that neighbourhood, then
    every node is linked with its smaller neighbours to the smallest of them.  The
    edge set never grows, ends as a set of stars and is stored each round;
    minima are combined before the shuffle, so a hub of any degree is fine.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )
    while True:
        if _are_stars(current):
            members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return members.unionByName(roots)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = stored(
            both.filter(F.col("b") > F.col("a"))
            .join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        is_low = F.col("b") == F.col("low")
        current = stored(
            large.join(low, "a")
            .select(F.when(is_low, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
            .distinct()
        )


def _are_stars(edges: DataFrame) -> bool:
    """True when every node has one smaller neighbour that itself has none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()
