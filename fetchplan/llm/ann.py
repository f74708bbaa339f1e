"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (``SAMPLE`` vectors by hash of the id);
every vector is then filed under a leaf.  A query traverses the tree best bin
first: a priority queue holds the nodes met so far by cosine to their centre,
the best is opened next, and leaves come out in the order to visit them.  How
many leaves each query visits is calibrated: the exact neighbours of a bounded
set of queries are found by comparing those with all rows, and visits widen
until the recall on them reaches ``recall`` (and until the leaves
visited hold ``k`` other ids).  At the last all leaves are visited, which is
the exact search.

Leaves of any size are split into chunks of about ``CHUNK`` rows by hash of the
row's number, queries into groups of about ``QUERIES``; each chunk and group that
meet is one bounded task unit, and gives its best ``k`` ids per query.  Scores are cosines in double
precision of the original vectors; candidates within rounding of the k-th
are all scored exactly, so ties go to the smaller id.

Vectors of different lengths are no neighbours: each length found has a tree of
its own, and queries of that length are answered from it.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, take no part, as query or candidate.  Rows that repeat an id count as one
candidate (the nearest of them) and one query.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fetchplan.llm.vectors import cosine, lengths, matrix, unit, valid
from fetchplan.session import checkpoint_dir

SAMPLE = 20_000
BRANCH = 12
LEAF = 64
CALIBRATION = 200
RECALL = 0.97
CHUNK = 4096
QUERIES = 4096
SLACK = 1e-9
#: Candidate rows a task holds before it cuts them to the best of each query.
HELD = 500_000


class Tree:
    """Node 0 is the root; children[i] is empty for a leaf, whose number is leaf[i]."""

    def __init__(self, sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 7):
        self.centres, self.children, self.leaf, self.n_leaves = [], [], [], 0
        rng = np.random.default_rng(seed)
        todo = [(sample, self._new(sample))]
        while todo:
            x, node = todo.pop()
            parts = self._split(x, branch, rng) if len(x) > leaf else []
            if len(parts) < 2:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1
                continue
            for part in parts:
                child = self._new(part)
                self.children[node].append(child)
                todo.append((part, child))
        self.stacked = [np.array([self.centres[c] for c in kids]) for kids in self.children]

    def _new(self, x: np.ndarray) -> int:
        mean = x.mean(axis=0) if len(x) else x.sum(axis=0)
        size = np.linalg.norm(mean)
        self.centres.append(mean / size if size > 0 else mean)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centres) - 1

    @staticmethod
    def _split(x: np.ndarray, branch: int, rng) -> list[np.ndarray]:
        c = x[rng.choice(len(x), min(branch, len(x)), replace=False)]
        for _ in range(8):
            near = np.argmax(x @ c.T, axis=1)
            sums = np.stack([x[near == k].sum(axis=0) for k in range(len(c))])
            sizes = np.linalg.norm(sums, axis=1, keepdims=True)
            c = np.where(sizes > 0, sums / np.maximum(sizes, 1e-300), c)
        near = np.argmax(x @ c.T, axis=1)
        return [x[near == k] for k in range(len(c)) if np.any(near == k)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row, by the nearest child at every level."""
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = np.argmax(x[rows] @ self.stacked[node].T, axis=1)
            todo += [(child, rows[near == k]) for k, child in enumerate(self.children[node]) if np.any(near == k)]
        return out

    def visits(self, q: np.ndarray):
        """Leaves in best-bin-first order."""
        queue = [(-1.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
            else:
                for s, child in zip((self.stacked[node] @ q).tolist(), self.children[node], strict=True):
                    heapq.heappush(queue, (-s, child))


def best(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest ids of rows (vid, v) of each query by exact cosine, an id by its nearest row.

    Equal ids never meet; ties go to the smaller id.
    """
    out: list[tuple] = []
    start = np.arange(len(vid))
    if len(np.unique(vid)) < len(vid):  # rows of one id side by side, exact repeats folded
        order = np.lexsort((*v.T, vid))
        vid, v = vid[order], v[order]
        new = np.append(True, (vid[1:] != vid[:-1]) | np.any(v[1:] != v[:-1], axis=1))
        vid, v = vid[new], v[new]
        start = np.flatnonzero(np.append(True, vid[1:] != vid[:-1]))
    uq, uv = unit(q), unit(v)
    for a in range(0, len(q), 256):
        s = uq[a:a + 256] @ uv.T
        s[qid[a:a + 256, None] == vid] = -np.inf
        top = s if len(start) == len(vid) else np.maximum.reduceat(s, start, axis=1)
        kth = np.partition(top, -k, axis=1)[:, -k] if k < len(start) else np.full(len(s), -2.0)
        i, j = np.nonzero(s >= np.maximum(kth, -2.0)[:, None] - SLACK)
        exact = cosine(q[a + i], v[j]) if len(i) else np.zeros(0)
        if len(start) < len(vid):  # one row, the nearest, of each query and id
            order = np.lexsort((-exact, vid[j], i))
            order = order[np.append(True, (np.diff(i[order]) != 0) | (np.diff(vid[j[order]]) != 0))[:len(order)]]
            i, j, exact = i[order], j[order], exact[order]
        order = np.lexsort((vid[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.searchsorted(i, np.arange(len(s)))
        keep = np.arange(len(i)) - first[i] < k if len(i) else np.zeros(0, bool)
        out.append((qid[a + i[keep]], vid[j[keep]], exact[keep]))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return tuple(np.concatenate(x) for x in zip(none, *out, strict=True))


def _table(found: tuple) -> dict:
    return {"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())}


def fewest(found: tuple, k: int) -> tuple:
    """Of (query, id, score) rows the k best ids of each query, an id by its best row; ties go to the smaller id."""
    qid, vid, score = found
    order = np.lexsort((-score, vid, qid))
    qid, vid, score = qid[order], vid[order], score[order]
    new = np.append(True, (np.diff(qid) != 0) | (np.diff(vid) != 0))[:len(qid)]
    qid, vid, score = qid[new], vid[new], score[new]
    order = np.lexsort((vid, -score, qid))
    qid, vid, score = qid[order], vid[order], score[order]
    keep = np.arange(len(qid)) - np.searchsorted(qid, qid) < k
    return qid[keep], vid[keep], score[keep]


def merged(k: int, held: int = HELD):
    """Of a task's candidates the k best of each query, however many leaves it met in; at most about ``held`` rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, limit = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0, held
        for batch in batches:
            parts.append(tuple(c.to_numpy() for c in batch.columns))
            size += batch.num_rows
            if size >= limit:
                parts = [fewest(tuple(map(np.concatenate, zip(*parts, strict=True))), k)]
                size = len(parts[0][0])
                limit = max(held, 2 * size)
                if size >= 4 * held:  # more queries than fit: these are handed on
                    yield pa.RecordBatch.from_pydict(_table(parts.pop()))
                    parts, size, limit = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0, held
        yield pa.RecordBatch.from_pydict(_table(fewest(tuple(map(np.concatenate, zip(*parts, strict=True))), k)))

    return run


def exact_for(rows: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """Best k of a small set of queries over all rows: each task keeps its own best, then they are ranked."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = shared.value
        for batch in batches:
            vid = batch.column(0).to_numpy()
            if len(vid):
                yield pa.RecordBatch.from_pydict(_table(best(qid, q, vid, matrix(batch.column(1), q.shape[1]), k)))

    kind = "query_id long, vec_id long, score double"
    return ranked(rows.select("vec_id", "v").mapInArrow(run, kind).mapInArrow(merged(k), kind), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return one.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL,
           sample: int = SAMPLE, calibration: int = CALIBRATION) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``is_query`` (over column vec_id) holds."""
    checkpoint_dir(rows.sparkSession)
    base = (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
            .where(F.col("vec_id").isNotNull() & valid(F.col("v"))))
    found = base.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    for d in lengths(base, "v"):
        found = found.unionByName(_search(base.where(F.size("v") == d), d, is_query, k, recall, sample, calibration))
    return ranked(found, k)


def _search(base: DataFrame, d: int, is_query: Column, k: int, recall: float, sample: int, calibration: int) -> DataFrame:
    """(query_id, vec_id, score) candidates among rows (vec_id, v) of length ``d``, at least the k best of those visited."""
    context = base.sparkSession.sparkContext

    def bounded(df: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
        got = df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).toArrow()
        ids, v = got.column("vec_id").to_numpy(), matrix(got.column("v"), d)
        _, first = np.unique(ids, return_index=True)
        return ids[first], v[first]

    tree = Tree(unit(bounded(base, sample)[1]))
    shared = context.broadcast(tree)

    @F.arrow_udf("int")
    def leaf_of(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in values:
            yield pa.array(shared.value.assign(unit(matrix(v, d))), type=pa.int32())

    filed = base.withColumn("leaf", leaf_of("v")).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    asked = filed.where(is_query)
    sizes = np.zeros(tree.n_leaves, np.int64)
    for r in filed.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    ids_held = np.zeros(tree.n_leaves, np.int64)  # each id counts in one leaf only
    for r in filed.groupBy("vec_id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").count().collect():
        ids_held[r["leaf"]] = r["count"]
    n_queries = asked.count()

    test = bounded(asked, calibration)
    wanted = exact_for(filed, test, k).select("query_id", "vec_id").collect()  # k rows for each calibration query
    lie = {}
    ids = sorted({r["vec_id"] for r in wanted})
    for r in filed.where(F.col("vec_id").isin(ids)).select("vec_id", "leaf").collect():
        lie.setdefault(r["vec_id"], []).append(r["leaf"])
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(x))} for i, x in zip(test[0], unit(test[1]), strict=True)}
    depth = np.sort([min(place[r["query_id"]][x] for x in lie[r["vec_id"]]) for r in wanted]) if wanted else np.zeros(0, np.int64)
    width = int(depth[min(len(depth) - 1, int(np.ceil(recall * len(depth))))]) + 1 if len(depth) else tree.n_leaves

    chunks = np.maximum(1, -(-sizes // CHUNK))
    groups = max(1, -(-n_queries // QUERIES))
    plan = context.broadcast((sizes, ids_held, chunks))

    @F.arrow_udf("array<struct<leaf:int,chunk:int>>")
    def to_visit(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, ids_in, split = plan.value
        kind = pa.list_(pa.struct([("leaf", pa.int32()), ("chunk", pa.int32())]))
        for v in values:
            out = []
            for q in unit(matrix(v, d)):
                some, seen = [], 0
                for n, leaf in enumerate(shared.value.visits(q)):
                    if n >= width and seen > k:
                        break
                    seen += int(ids_in[leaf])
                    some += [{"leaf": leaf, "chunk": c} for c in range(int(split[leaf]))] if held[leaf] else []
                out.append(some)
            yield pa.array(out, type=kind)

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        vid, v = right.column("vec_id").to_numpy(), matrix(right.column("v"), d)
        qid, q = left.column("query_id").to_numpy(), matrix(left.column("q"), d)
        if not len(qid) or not len(vid):
            return pa.table(_table(best(qid[:0], q[:0], vid[:0], v[:0], k)))
        return pa.table(_table(best(qid, q, vid, v, k)))

    many = F.lit([int(x) for x in chunks])
    stored = filed.select(
        "leaf", F.pmod(F.xxhash64("row"), F.element_at(many, F.col("leaf") + 1)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "vec_id", "v")
    posed = (asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.explode(to_visit("v")).alias("at"))
             .select(F.col("at.leaf").alias("leaf"), F.col("at.chunk").alias("chunk"),
                     F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("group"), "query_id", "q"))
    keys = ["leaf", "chunk", "group"]
    kind = "query_id long, vec_id long, score double"
    return posed.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(meet, kind).mapInArrow(merged(k), kind)
