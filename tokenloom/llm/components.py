"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

# Edges of 64-bit nodes, 4 MB of them, up to which one task ties them all; more are never in one task.
FEW_EDGES = 1 << 18


def connected_components(edges: DataFrame, *, few: int = FEW_EDGES) -> DataFrame:
    """(node, component) of every node on an edge (a, b); a component is its smallest node.

    Large-star and small-star steps alternate until the edges are stars around the smallest
    nodes, which takes a number of rounds that grows with the logarithm of the longest chain.
    Minima are aggregated before any shuffle, so a hub's neighbours are never gathered.
    A graph of at most `few` edges is too small for rounds of shuffles: one task ties it.
    """
    current = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = stored(current.distinct(), "edges")
    if {kind for _, kind in current.dtypes} == {"bigint"} and current.count() <= few:
        return current.repartition(1).mapInArrow(_tie, "node bigint, component bigint")
    mark = None
    while True:
        seen = _fingerprint(current)
        if seen == mark:
            break
        mark = seen
        current = stored(_small_star(_large_star(current)), "edges")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) over all edges of the task: roots hook to smaller ones until none can."""
    parts = [[np.asarray(b[c]) for c in ("a", "b")] for b in batches]
    if not parts:
        return
    a, b = (np.concatenate(x) for x in zip(*parts))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root, before = np.arange(len(nodes)), None
    while before is None or not np.array_equal(root, before):
        before = root
        least = np.minimum(root[a], root[b])
        root = root.copy()
        np.minimum.at(root, before[a], least)
        np.minimum.at(root, before[b], least)
        while not np.array_equal(root, root[root]):
            root = root[root]
    yield pa.record_batch([pa.array(nodes), pa.array(nodes[root])], ["node", "component"])


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(others).distinct()
