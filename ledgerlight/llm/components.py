"""Connected components of a link table: union-find inside each partition, then star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerlight.session import cut

TASK_LINKS = 500_000  # links that one task's union-find holds, about


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over a partition's links; gives each node with the smallest node of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = np.fromiter(parent, dtype=np.int64, count=len(parent))
    roots = np.fromiter((root(x) for x in parent), dtype=np.int64, count=len(parent))
    other = nodes != roots
    yield pd.DataFrame({"a": nodes[other], "b": roots[other]})


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node either is a root or hangs from one root."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("root"))
    ends = ends.union(edges.select(F.col("b"), F.lit(0), F.lit(1)))
    sums = ends.groupBy("v").agg(F.sum("child").alias("n"), F.max("root").alias("root"))
    return sums.where("n > 1 OR (n = 1 AND root = 1)").isEmpty()


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a table of links between longs; the component is its smallest node.

    The links are dealt out to as many tasks as they need at TASK_LINKS each, whatever nodes they join; each keeps a
    spanning forest. A forest of several tasks is contracted in rounds that halve the depth of the trees at least. A
    node with many links is no hot key there: its least neighbour is a partial aggregate, and the joins that follow it
    are split at run time. Links with a null end and links of a node with itself say nothing and are left out; no links
    give no rows.
    """
    edges = cut(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"), "links")
    tasks = max(1, -(-edges.count() // TASK_LINKS))
    edges = cut(edges.repartition(tasks).mapInPandas(_forest, "a long, b long"), "forest")
    while tasks > 1 and not _is_forest(edges):
        edges = cut(_small_star(_large_star(edges)).where("a > b").distinct(), "forest")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
