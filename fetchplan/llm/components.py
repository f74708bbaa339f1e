"""Connected components of an edge table of any size.

Each task first contracts its edges, ``LOCAL`` at a time, to a forest of stars
around the smallest node.  Once at most ``LOCAL`` edges are left, one task
finishes.  While there are more, large and small stars alternate: a grouping
and a join each, whose rows never exceed the edges'; skewed joins are split by
adaptive execution and minima are taken before the shuffle.  Rounds are cut by
``checkpoint()`` into the session's shared folder, so a lost executor costs no
earlier round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.session import checkpoint_dir

#: Edges (16 bytes each) that one task contracts at a time.
LOCAL = 1_000_000


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest of the nodes 0..n-1 that each reaches through the links (u, v)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def contract(limit: int = LOCAL):
    """Edges, without nulls, to stars (u: node, v: smallest node reached), ``limit`` at a time."""
    def stars(parts: list) -> pa.RecordBatch:
        edges = np.concatenate([np.zeros((2, 0), np.int64), *parts], axis=1)
        nodes, at = np.unique(edges, return_inverse=True)
        at = at.reshape(edges.shape)
        label = forest(len(nodes), at[0], at[1])
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_pydict({"u": pa.array(nodes[moved]), "v": pa.array(nodes[label[moved]])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
            size += batch.num_rows
            if size >= limit:
                yield stars(parts)
                parts, size = [], 0
        yield stars(parts)

    return run


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", local: int = LOCAL, contracted: bool = False) -> DataFrame:
    """(node, component) of every node with an edge to another; component is the smallest node reachable.

    Null ends and loops are dropped; repeated edges count once.  ``contracted``: the tasks that made the edges
    have put them through ``contract`` already, so a task needs one Python worker and not one a step.
    """
    checkpoint_dir(edges.sparkSession)
    a, b, kind = F.col(a).cast("long"), F.col(b).cast("long"), "u long, v long"
    e = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e, seen = (e if contracted else e.mapInArrow(contract(local), kind)).checkpoint(), None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] <= local:
            e = e.repartition(1).mapInArrow(contract(local + 1), kind)
            break
        if mark == seen:
            break
        seen = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
    e = e.checkpoint()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
