"""Embedding near-duplicates by an epsilon grid order join.

A cosine of at least ``t`` between unit vectors is a distance of at most
``eps = sqrt(2 - 2t)``.  Vectors are turned to principal axes (the covariance
is summed over all of them), sorted by their grid cells of width ``eps`` on the
leading axes, and cut into blocks of consecutive vectors.  A tree over the
sequence holds each interval's bounding box on those axes and the range of what
the other axes hold; the join descends it and skips intervals whose boxes lie
further apart than ``eps``.  Surviving block pairs go to a task each, which
halves them the same way and compares the rest in double precision.

A task returns link counts and a spanning forest of the links it found, never
all pairs, so groups of near copies do not blow up; connectivity is kept whole.
Exact copies are one vector with a count from the start.

Vectors of different lengths never link; each length found is joined by itself.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing: no links, a component of their own.  Rows with a null id link with
nothing, and have a null component.  Rows that repeat a vec_id are one node in components
(they tie the vectors they hold together), each row being a vector of its own in
link counts.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.components import connected_components, forest
from fetchplan.llm.vectors import cosine, lengths, matrix, unit, valid
from fetchplan.session import checkpoint_dir

#: Vectors a block holds at least; more where there would be more than MAX_BLOCKS.
BLOCK = 4096
#: Bounds what is broadcast: a box of 2 * (AXES + 1) doubles a block.
MAX_BLOCKS = 32_768
AXES = 8
TILE = 512
#: Slack for rounding in projected distances and in the first product.
SLACK = 1e-6


def principal_axes(rows: DataFrame, d: int) -> np.ndarray:
    """Axes (columns, by falling variance) of the unit vectors in column ``v``; the driver gets d * (d + 1) sums."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, s, n = np.zeros((d, d)), np.zeros(d), 0
        for batch in batches:
            x = unit(matrix(batch.column(0), d))
            total, s, n = total + x.T @ x, s + x.sum(axis=0), n + len(x)
        i, j = np.indices((d, d)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.full(d, -1), [-2]])), pa.array(np.concatenate([j, np.arange(d), [0]])),
             pa.array(np.concatenate([total.ravel(), s, [float(n)]]))], names=["i", "j", "s"])

    got = rows.select("v").mapInArrow(sums, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    by = {(r["i"], r["j"]): r["s"] for r in got}
    n = max(1.0, by.get((-2, 0), 0.0))
    mean = np.array([by.get((-1, j), 0.0) for j in range(d)]) / n
    cov = np.array([[by.get((i, j), 0.0) for j in range(d)] for i in range(d)]) / n - np.outer(mean, mean)
    return np.linalg.eigh((cov + cov.T) / 2)[1][:, ::-1]


def _box(p: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Lower and upper ends of a set of vectors on the leading axes, and of the length of what is left."""
    q = np.column_stack([p, rest])
    return np.stack([q.min(axis=0), q.max(axis=0)])


def _gap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squared distance between boxes [..., 2, axes]; lengths of remainders differ no more than these do."""
    return np.square(np.maximum(0, np.maximum(a[..., 0, :] - b[..., 1, :], b[..., 0, :] - a[..., 1, :]))).sum(axis=-1)


class SequenceTree:
    """Boxes of all intervals that halving the block sequence gives."""

    def __init__(self, boxes: np.ndarray):
        self.levels = [boxes]
        while len(self.levels[-1]) > 1:
            x = self.levels[-1]
            if len(x) % 2:
                x = np.concatenate([x, x[-1:]])
            self.levels.append(np.stack([np.minimum(x[::2, 0], x[1::2, 0]), np.maximum(x[::2, 1], x[1::2, 1])], axis=1))

    def near(self, k: int, limit: float) -> np.ndarray:
        """Blocks that block ``k`` may reach: intervals provably too far are skipped whole."""
        box, at = self.levels[0][k], np.array([0])
        for depth in reversed(range(len(self.levels))):
            at = at[_gap(self.levels[depth][at], box) <= limit]
            if depth:
                at = np.concatenate([2 * at, 2 * at + 1])
                at = at[at < len(self.levels[depth - 1])]
        return np.sort(at)


class PairJoin:
    """Joins two blocks (or one with itself) by halving intervals down to tiles."""

    def __init__(self, a: dict, b: dict, same: bool, threshold: float, eps2: float):
        self.a, self.b, self.same, self.threshold, self.eps2 = a, b, same, threshold, eps2
        self.links_a, self.links_b = np.zeros(len(a["id"]), np.int64), np.zeros(len(b["id"]), np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.skipped = 0

    def join(self, i0: int, i1: int, j0: int, j1: int) -> None:
        if self.same and j1 <= i0 or i0 >= i1 or j0 >= j1:
            return
        a, b = self.a, self.b
        if _gap(_box(a["p"][i0:i1], a["rest"][i0:i1]), _box(b["p"][j0:j1], b["rest"][j0:j1])) > self.eps2:
            self.skipped += 1
            return
        if max(i1 - i0, j1 - j0) > TILE:
            im, jm = (i0 + i1 + 1) // 2, (j0 + j1 + 1) // 2
            for x in ((i0, im), (im, i1)):
                for y in ((j0, jm), (jm, j1)):
                    self.join(*x, *y)
            return
        i, j = np.nonzero(a["u"][i0:i1] @ b["u"][j0:j1].T >= self.threshold - SLACK)
        i, j = i + i0, j + j0
        if self.same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return
        sure = cosine(a["v"][i], b["v"][j]) >= self.threshold
        i, j = i[sure], j[sure]
        np.add.at(self.links_a, i, b["n"][j])
        np.add.at(self.links_b, j, a["n"][i])
        lo, width = i0, i1 - i0
        label = forest(width + j1 - j0, i - lo, j - j0 + width)
        ids = np.concatenate([a["id"][i0:i1], b["id"][j0:j1]])
        moved = np.flatnonzero(label != np.arange(len(label)))
        self.edges.append((ids[moved], ids[label[moved]]))


def near_links(classes: DataFrame, d: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, links, peer) rows for distinct vectors (id, n, v): link counts, or one edge of a spanning forest."""
    spark = classes.sparkSession
    axes = principal_axes(classes, d)
    k, eps2 = min(AXES, d), 2 - 2 * threshold + SLACK
    eps = float(np.sqrt(max(eps2, SLACK)))

    @F.arrow_udf("cells array<int>, first double")
    def cells(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in values:
            p = unit(matrix(v, d)) @ axes[:, :k]
            flat = np.floor(p / eps).astype(np.int32).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k, dtype=np.int32)), pa.array(flat))
            yield pa.StructArray.from_arrays([lists, pa.array(p[:, 0].copy())], ["cells", "first"])

    n = classes.count()
    block = max(block, -(-n // MAX_BLOCKS))
    kind = np.float32 if classes.schema["v"].dataType.elementType.typeName() == "float" else np.float64

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, size = TaskContext.get().partitionId() << 24, 0, [], 0

        def out(rows: list) -> pa.RecordBatch:
            ids, ns, v = (np.concatenate(x) for x in zip(*rows, strict=True))
            u = unit(v)
            p = u @ axes[:, :k]
            box = _box(p, np.sqrt(np.maximum(0, 1 - np.square(p).sum(axis=1))))
            return pa.RecordBatch.from_arrays(
                [pa.array([part + made]), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, ns, v.astype(kind))),
                 pa.array([box.ravel().tolist()])], names=["block", "ids", "ns", "vs", "box"])

        for batch in batches:
            at, rows = 0, (batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2), d))
            while at < len(rows[0]):
                take = min(block - size, len(rows[0]) - at)
                held.append(tuple(x[at:at + take] for x in rows))
                at, size = at + take, size + take
                if size == block:
                    yield out(held)
                    made, held, size = made + 1, [], 0
        if held:
            yield out(held)

    key = classes.withColumn("c", cells("v")).select("id", "n", "v", F.col("c.cells").alias("cells"), F.col("c.first").alias("first"))
    blocks = (key.repartitionByRange(max(1, round(n / block)), "cells", "first", "id").sortWithinPartitions("cells", "first", "id")
              .select("id", "n", "v").mapInArrow(cut, "block long, ids binary, ns binary, vs binary, box array<double>").checkpoint())
    boxes = {r["block"]: r["box"] for r in blocks.select("block", "box").collect()}  # at most 2 * MAX_BLOCKS or so
    order = sorted(boxes)
    tree = spark.sparkContext.broadcast((np.array(order), np.array([boxes[x] for x in order]).reshape(len(order), 2, k + 1)))

    @F.arrow_udf("array<struct<a:long,b:long>>")
    def partners(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, of = tree.value
        search = SequenceTree(of)
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for v in values:
            out = []
            for x in v.to_pylist():
                near = names[search.near(int(np.searchsorted(names, x)), eps2)]
                out.append([{"a": min(x, y), "b": max(x, y)} for y in near.tolist()])
            yield pa.array(out, type=kind)

    def join(table: pa.Table) -> pa.Table:
        sides = []
        for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
            v = np.frombuffer(r["vs"], kind).astype(np.float64).reshape(-1, d)
            u = unit(v)
            p = u @ axes[:, :k]
            sides.append({"id": np.frombuffer(r["ids"], np.int64), "n": np.frombuffer(r["ns"], np.int64), "v": v, "u": u, "p": p,
                          "rest": np.sqrt(np.maximum(0, 1 - np.square(p).sum(axis=1)))})
        same = len(sides) == 1
        job = PairJoin(sides[0], sides[-1], same, threshold, eps2)
        job.join(0, len(sides[0]["id"]), 0, len(sides[-1]["id"]))
        counted = [(sides[0]["id"], job.links_a), (sides[-1]["id"], job.links_b)]
        node = np.concatenate([x[c > 0] for x, c in counted] + [e[0] for e in job.edges])
        links = np.concatenate([c[c > 0] for _, c in counted])
        peer = np.concatenate([np.zeros(0, np.int64)] + [e[1] for e in job.edges])
        none = np.zeros(len(peer), np.int64)
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(np.concatenate([links, none]), pa.int64()),
                         "peer": pa.array(np.concatenate([np.zeros(len(links), np.int64), peer]), pa.int64(),
                                          mask=np.concatenate([np.ones(len(links), bool), none.astype(bool)]))})

    pairs = (blocks.select("block", "ids", "ns", "vs", F.explode(partners("block")).alias("pair"))
             .select("pair.a", "pair.b", "block", "ids", "ns", "vs"))
    return pairs.groupBy("a", "b").applyInArrow(join, "node long, links long, peer long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                    block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept (whether it is its component's smallest id)."""
    checkpoint_dir(rows.sparkSession)
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    keyed = base.withColumn("ok", F.col("vec_id").isNotNull() & valid(F.col("v"))).select(
        "vec_id", "ok", F.when(F.col("ok"), F.xxhash64("v")).alias("k1"), F.when(F.col("ok"), F.xxhash64(F.lit(7), "v")).alias("k2"),
        "v")
    classes = (keyed.where("ok").groupBy("k1", "k2")
               .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v"))
               .withColumn("node", F.monotonically_increasing_id()).checkpoint())  # classes may share their smallest id
    found = classes.select("node", F.lit(0).cast("long").alias("links"), F.lit(None).cast("long").alias("peer")).limit(0)
    for d in lengths(classes, "v"):
        some = classes.where(F.size("v") == d).select(F.col("node").alias("id"), "n", "v")
        found = found.unionByName(near_links(some, d, threshold, block))
    found = found.checkpoint()
    links = found.where("peer is null").groupBy("node").agg(F.sum("links").alias("links"))
    again = (keyed.where("ok").groupBy("vec_id").agg(*(f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in ("k1", "k2")))
             .where("min_k1 != max_k1 or min_k2 != max_k2").select("vec_id"))
    held = (keyed.where("ok").select("vec_id", "k1", "k2").join(again, "vec_id").join(classes.select("k1", "k2", "node"), ["k1", "k2"])
            .select("vec_id", "node").distinct().checkpoint())
    same = held.join(held.groupBy("vec_id").agg(F.min("node").alias("peer")), "vec_id").select("node", "peer")
    component = connected_components(found.where("peer is not null").select("node", "peer").unionByName(same), "node", "peer")
    facts = (classes.select("k1", "k2", "node", "id", "n").join(links, "node", "left").join(component, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    facts = (facts.join(facts.groupBy("component").agg(F.min("id").alias("component_id")), "component")
             .select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    named = keyed.where("ok").select("vec_id", "k1", "k2").join(facts, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    plain = keyed.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    tied = (keyed.where("ok").select("vec_id", "k1", "k2").join(plain.select("vec_id").distinct(), "vec_id", "left_semi")
            .join(facts, ["k1", "k2"]).groupBy("vec_id").agg(F.min("component_id").alias("component_id")))
    plain = plain.join(tied, "vec_id", "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return named.unionByName(plain).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
