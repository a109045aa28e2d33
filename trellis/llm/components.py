"""Connected components by alternating large and small stars, with local contraction first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import discard, map_arrow, materialize

class Forest:
    """Union-find over hashable nodes; the root of a tree is its smallest node."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        if y < x:
            x, y = y, x
        self.parent[y] = x
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of this partition by the stars of its own components."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.union(a, b)
    nodes = list(forest.parent)
    roots = [forest.find(x) for x in nodes]
    u, v = np.array(nodes, dtype=np.int64), np.array(roots, dtype=np.int64)
    moved = u != v
    yield pa.RecordBatch.from_arrays([pa.array(u[moved]), pa.array(v[moved])], names=["u", "v"])


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step on links (u > v): hang the larger neighbours (large) or the smaller ones (small) on the smallest.

    The least neighbours are a written table like the links, so that adaptive execution can split a hub's links.
    """
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least")
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = links.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    after = materialize(out.filter("u <> v").distinct(), "links")
    discard(least, links)
    return after


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the (u, v) links that isn't its own root; the root is the smallest node.

    Each round's links are written to the shared folder, so a lost executor costs one round at most.  The rounds end
    when one changes nothing, after a number of them that grows with the logarithm of the largest component.
    """
    links = links.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u is not null and v is not null and u <> v")
    links = materialize(map_arrow(links, _contract, "u long, v long"), "links")
    state = None
    while True:
        after = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(after) == state or not after["n"]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(after)
        links = _stars(_stars(links, True), False)
