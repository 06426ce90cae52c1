"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import materialize

#: Links that a task writes, where there are enough for all tasks that run at once.
LINKS = 100_000


def forest(pairs: np.ndarray) -> np.ndarray:
    """One link from each node but one of each connected part to its smallest node."""
    nodes, ends = np.unique(pairs.view(np.int64), return_inverse=True)
    ends = ends.reshape(-1, 2)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[ends[:, 0]], root[ends[:, 1]])
        new = root.copy()
        np.minimum.at(new, root[ends[:, 0]], low)
        np.minimum.at(new, root[ends[:, 1]], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    far = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[far], nodes[root[far]]], axis=1)


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour is tied to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").where("b <> least")
    return least.select("a", F.col("least").alias("b")).unionByName(
        tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def _in_files(rows: DataFrame, count: int) -> DataFrame:
    """About ``count`` rows in no more parts than they need: each stored part is a file of its own."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // LINKS)))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that links reach, for every node of a link.

    ``edges`` has long columns ``a`` and ``b``. Work of a round is a few joins
    and sums over the edges; a node of many links is split like any hot join
    key. The number of rounds grows with the logarithm of the longest path. What a round
    stores has few files, however many parts a shuffle has.
    """
    now = materialize(_downward(edges), "links")
    mark = _mark(now)
    while True:
        now = materialize(_in_files(_downward(_small_star(_downward(_large_star(now)))), mark[0]), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = _in_files(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct(), mark[0])
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
