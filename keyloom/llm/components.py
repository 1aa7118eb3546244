"""Connected components of a link table by alternating large-star and small-star joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Rows ``(node, component)`` for every node that occurs in ``links``; component is the smallest node reachable.

    Links are undirected; self links and rows with a null end are ignored, repeated links count once. Each round is
    two grouped minima and two joins over the links, so no component meets in one task, and is written to the shared
    folder. The work ends when a round leaves the table as it was.
    """
    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 with links (a[i], b[i]): the smallest node that each one reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, step := new[new]):
            new = step
        if np.array_equal(new, root):
            return root
        root = new
