"""Connected components of a graph given as pairs of longs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildbook.llm.common import staged


def forest(pairs: np.ndarray) -> np.ndarray:
    """Of pairs (an n x 2 array), the stars of their components: every node but the least with the least. For arrays in a task."""
    if not len(pairs):
        return pairs
    nodes, at = np.unique(pairs.ravel(), return_inverse=True)
    a, b = at.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if np.array_equal(ra, rb):
            break
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
    away = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[away], nodes[root[away]]], axis=1)


def components(links: DataFrame, name: str) -> DataFrame:
    """(name, root) of every node that links (a, b) touch; root is the least node of its component.

    Rounds of contraction: every node hooks on its least neighbour if that is less than itself, chains of hooks are
    followed to their ends, and links are renamed by the roots found, until none is left between different roots. A round
    leaves at most half of the nodes that still have links. All joins are between written tables, so that Spark can split a
    node with many links."""
    left = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    placed = None
    while not left.isEmpty():
        # The greater node of a link hooks on the least node that it has a link with.
        hooks = staged(left.groupBy("b").agg(F.min("a").alias("up")).select(F.col("b").alias("node"), "up"), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            jumped = staged(hooks.join(above, "up", "left").select("node", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved")), "jumped")
            hooks = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        if placed is None:
            tops = left.select(F.col("a").alias("node")).join(hooks, "node", "left_anti").distinct()
            placed = staged(hooks.unionByName(tops.select("node", F.col("node").alias("up"))), "placed")
        else:
            renamed = hooks.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            placed = staged(placed.join(renamed, "up", "left").select("node", F.coalesce("higher", "up").alias("up")), "placed")
        for end in ("a", "b"):
            renamed = hooks.select(F.col("node").alias(end), "up")
            left = left.join(renamed, end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        left = staged(left.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if placed is None:
        placed = left.select(F.col("a").alias("node"), F.col("b").alias("up"))
    return placed.select(F.col("node").alias(name), F.col("up").alias("root"))
