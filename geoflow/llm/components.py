"""Connected components: within one task in numpy, across tasks by rounds of contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def star_edges(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of n nodes, given links between them."""
    return hooked(np.arange(n), left, right)


def hooked(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest members after more links; root, those found so far, may be changed."""
    while len(left):
        # only roots are hooked, so that no tree comes apart; a link goes when both its ends have the same root
        a, b = root[left], root[right]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
    return root


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (node, root): the smallest node of the component of every node that has an edge. edges: bigint columns u, v.

    Every round gives each node its smallest neighbour and contracts along these pointers. Every node that isn't smaller
    than all its neighbours goes, so at least half of those with edges do, and the rounds grow with the logarithm of the
    number of nodes. Nodes with many edges are handled by partial aggregation and adaptive skew joins.
    """
    edges = scratch.keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    roots: DataFrame | None = None
    while not edges.isEmpty():
        lowest = scratch.keep(
            edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
            .groupBy(F.col("e.u").alias("node"))
            .agg(F.least(F.col("node"), F.min("e.v")).alias("root"))
        )
        if roots is None:
            newer = lowest
        else:
            step = lowest.select(F.col("node").alias("root"), F.col("root").alias("to"))
            newer = scratch.keep(roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
            scratch.drop(roots)
        ends = lowest.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        others = lowest.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        moved = edges.join(ends, "u").join(others, "v").where("ru <> rv")
        fewer = scratch.keep(moved.select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v")).distinct())
        scratch.drop(edges)
        if roots is not None:
            scratch.drop(lowest)
        edges, roots = fewer, newer
    return roots if roots is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
