"""Connected components of a table of edges, by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    Each round a node hooks to its smallest neighbour if that is smaller, the
    hooks are followed a few steps, and the edges are rewritten between what the
    nodes now stand for, until none joins two. The smallest node of a component
    never hooks, so it names it in the end. All rounds are joins and aggregates
    of stored tables; only the number of edges left comes to the driver.
    """
    edges = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .distinct(), f"{name}-edges-0")
    labels, turn = None, 0
    while edges.head(1):
        turn += 1
        # every non-smallest end hooks; nodes that are nobody's larger end stay
        hooks = scratch.keep(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), f"{name}-hooks-{turn}")
        for step in range(2):
            further = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
            hooks = scratch.keep(hooks.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to")),
                                 f"{name}-hooks-{turn}-{step}")
        if labels is None:
            nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
            now = nodes.join(hooks, "node", "left").select("node", F.coalesce("to", "node").alias("component"))
        else:
            by = hooks.select(F.col("node").alias("component"), "to")
            now = labels.join(by, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = scratch.keep(now, f"{name}-labels-{turn}")
        left, right = hooks.toDF("a", "a_to"), hooks.toDF("b", "b_to")
        rewritten = (edges.join(left, "a", "left").join(right, "b", "left")
                     .select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b")).where("a <> b")
                     .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        edges = scratch.keep(rewritten, f"{name}-edges-{turn}")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
