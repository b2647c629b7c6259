"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import freed, staged, tidied

#: Edges that one task can link: 16 MB of them, whatever the input.
FEW = 1 << 20


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u")
    links = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
    return links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def rooted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        # of two roots the larger one goes under the smaller, then every node goes under its root
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


@tidied
def _linked(batches):
    if held := [[b.column(c).to_numpy() for c in ("u", "v")] for b in batches]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rooted(*map(np.concatenate, zip(*held)))], ["node", "root"])


def components(edges: DataFrame, rounds: int = 60, few: int = 0) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; root is the smallest node of its component.

    Each round is written to the shared folder; the driver gets only a count and a checksum. A node joins
    through partial aggregates and skew-split joins, so one with very many neighbours is no single task.
    Where at most ``few`` edges are left one task links them: a round is some 24 stages, whose plans the driver holds.
    """
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.hash("v", "u").cast("long"))).first())
    last = sign(now)
    for _ in range(rounds if last[0] else 0):
        if few:
            if last[0] <= few:
                return now.coalesce(1).mapInArrow(_linked, "node long, root long")
            freed(edges.sparkSession)
        now = staged(_small_star(_large_star(now)), "edges")
        if (at := sign(now)) == last:
            break
        last = at
    else:
        if last[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
