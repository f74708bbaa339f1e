"""Embedding join and nearest neighbours against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.llm_helpers import roots
from pyspark.sql import functions as F

from fetchplan.llm import ann, embedding_join, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(n=400, d=16, seed=3):
    """Clusters of near copies, exact copies, scaled copies, loose vectors, and rows that take no part."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[50:120] = x[50] + rng.normal(size=(70, d)) * 0.16
    x[120:160] = x[120]
    x[160:170] = x[160] * np.arange(1, 11)[:, None]
    x[170] = -x[160]
    rows = [(int(k), [float(np.float32(c)) for c in v], int(k % 3)) for k, v in enumerate(x)]
    odd = [(n, None, 0), (n + 1, [0.0] * d, 0), (n + 2, [None] + [1.0] * (d - 1), 0), (n + 3, [float("nan")] * d, 0),
           (n + 4, [float("inf")] + [0.0] * (d - 1), 0), (n + 5, [], 0), (n + 6, [1.0] * (d - 1), 0), (None, rows[5][1], None),
           (n + 50, [1e-30] * d, 0), (n + 100, [3e38] * d, None)]
    return rows + odd, d


def taking(rows, d):
    return [(i, np.array(v, np.float64)) for i, v, _ in rows
            if i is not None and v and len(v) == d and None not in v and np.all(np.isfinite(v)) and np.any(np.array(v) != 0)]


def cosines(rows):
    x = np.array([v for _, v in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    return x @ x.T


@pytest.mark.parametrize("block", [32, 4096])
def test_near_duplicates(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_join, "TILE", 16)
    rows, d = made()
    rows.append(rows[20])  # a repeated row
    part = taking(rows, d)
    s = cosines(part) >= 0.95
    np.fill_diagonal(s, False)
    root = roots({i for i, _ in part}, [(part[a][0], part[b][0]) for a, b in zip(*np.nonzero(s), strict=True)])
    want = sorted((i, int(s[k].sum()), root[i], i == root[i]) for k, (i, _) in enumerate(part))
    ids = {i for i, _ in part}
    want += sorted((i, 0, i, True) for i, _, _ in rows if i is not None and i not in ids)
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).withColumn("id", F.lit("x"))
    got = embedding_join.near_duplicates(df, threshold=0.95, block=block).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, False)]
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None) == sorted(want)


def test_repeated_ids_tie_components(spark):
    """An id with two vectors ties what they link to; classes of one smallest id count their links apart."""
    x, y, z = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(3, x, 0), (5, x, 0), (5, y, 0), (9, y, 0), (5, None, 0), (1, [1.0, -1.0, 0.0], 0), (1, z, 0), (7, z, 0), (8, [0.01, 0.0, 1.0], 0)]
    got = embedding_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (9, 1, 3, False), (5, 0, 3, False),
            (1, 0, 1, True), (1, 2, 1, True), (7, 2, 1, False), (8, 2, 1, False)]
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted(want)


def test_distant_intervals_are_skipped():
    rng = np.random.default_rng(0)
    boxes = np.sort(rng.uniform(size=(37, 2, 3)), axis=1)
    tree = embedding_join.SequenceTree(boxes)
    for k in range(37):
        want = np.flatnonzero(embedding_join._gap(boxes, boxes[k]) <= 0.02)
        assert tree.near(k, 0.02).tolist() == want.tolist()


def plain_search(part, k, is_query):
    s = cosines(part)
    ids = np.array([i for i, _ in part])
    for q in sorted({i for i in ids.tolist() if is_query(i)}):
        best = {}
        for a in np.flatnonzero(ids == q):
            for b in np.flatnonzero(ids != q):
                best[ids[b]] = max(best.get(ids[b], -2.0), round(float(s[a, b]), 9))
        yield q, sorted(((-v, i) for i, v in best.items()))[:k]


def test_search_with_all_leaves_is_exact(spark):
    rows, d = made()
    rows += [rows[100], rows[130]]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("x"))
    got = {}
    for r in ann.search(df, F.col("vec_id") % 10 == 0, k=5, recall=1.0, sample=200).collect():
        got.setdefault(r.query_id, []).append((r["rank"], round(r.score, 9), r.vec_id))
    for q, want in plain_search(taking(rows, d), 5, lambda i: i % 10 == 0):
        assert [s for _, s, _ in sorted(got[q])] == [-s for s, _ in want]
        assert [x for x, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5]
    assert set(got) == {q for q, _ in plain_search(taking(rows, d), 5, lambda i: i % 10 == 0)}
    copies = sorted(got[130])  # forty equal rows: ties go to the smaller id
    assert [x for _, _, x in copies] == [120, 121, 122, 123, 124]


def test_repeated_ids_crowd_out_no_neighbours(spark):
    """An id that stands more than k times beside a query is one candidate; the 2nd to k-th neighbours stay."""
    rows, d = made()
    near = [int(i) for _, i in next(plain_search(taking(rows, d), 2, lambda i: i == 50))[1]]
    rows += [rows[near[0]]] * 7 + [(near[1], [float(np.float32(c * (1 + 1e-3 * n))) for c in rows[near[1]][1]], 0) for n in range(7)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search(df, F.col("vec_id") == 50, k=5, recall=1.0).collect())
    _, want = next(plain_search(taking(rows, d), 5, lambda i: i == 50))
    assert [x for _, x, _ in got] == [i for _, i in want] and [s for _, _, s in got] == [-s for s, _ in want]
    part = taking(rows, d)
    ids, v = np.array([i for i, _ in part]), np.array([x for _, x in part])
    alone = ann.best(ids[50:51], v[50:51], ids, v, 5)
    assert alone[1].tolist() == [i for _, i in want]


def test_visits_widen_to_k_ids(spark):
    """A leaf full of one id's rows does not end the visits."""
    rng = np.random.default_rng(2)
    a, b = np.eye(8)[0], np.eye(8)[1]
    rows = [(0, a, 0)] + [(1, a + rng.normal(size=8) * 1e-3, 0) for _ in range(80)]
    rows += [(k, b + rng.normal(size=8) * 1e-3, 0) for k in range(2, 120)]
    df = spark.createDataFrame([(i, [float(c) for c in v], x) for i, v, x in rows], SCHEMA)
    got = ann.search(df, F.col("vec_id") == 0, k=5, recall=0.0).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5] and len({r.vec_id for r in got}) == 5


def test_every_length_takes_part(spark):
    """Vectors of a rarer length link and are neighbours among themselves; a query id may have both lengths."""
    rows = [(k, [1.0, k / 10, 0.0], 0) for k in range(6)] + [(10, [1.0, 0.0], 0), (11, [2.0, 0.0], 0), (12, [0.0, 1.0], 0), (0, [1.0, 0.1], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_duplicates(df).collect() if r.vec_id >= 10}
    assert got == {10: (2, 0), 11: (2, 0), 12: (0, 12)}
    near = {}
    for r in sorted(ann.search(df, F.col("vec_id") % 10 == 0, k=3).collect(), key=lambda r: (r.query_id, r["rank"])):
        near.setdefault(r.query_id, []).append(r.vec_id)
    assert near == {0: [1, 10, 11], 10: [11, 0, 12]}


def test_search_recall(spark):
    """Calibrated visits reach the recall asked for on clustered vectors, without visiting all leaves."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 24))
    x = centres[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 24)) * 0.5
    df = spark.createDataFrame([(k, [float(c) for c in v], 0) for k, v in enumerate(x)], SCHEMA)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0, k=5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    hits = sum(len(got[q] & set(np.argsort(-s[q])[:5].tolist())) for q in range(0, 4000, 50))
    assert len(got) == 80 and hits >= 0.9 * 400


def test_vectors_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert embedding_join.near_duplicates(none).collect() == [] and ann.search(none, F.lit(True)).collect() == []
    bad = spark.createDataFrame([(1, None, 0), (2, [0.0, 0.0], 0), (None, [], 0)], SCHEMA)
    got = embedding_join.near_duplicates(bad).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got if r.vec_id) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert ann.search(bad, F.lit(True)).collect() == []
    few = spark.createDataFrame([(k, [1.0, float(k)], 0) for k in range(3)], SCHEMA)
    got = ann.search(few, F.col("vec_id") == 0, k=5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("held", [1, 7, 10_000])
def test_candidates_of_a_task_are_merged(held):
    """However candidates come in and whatever a task may hold, the k best ids of each query are among what it hands on."""
    rng = np.random.default_rng(held)
    found = [(int(q), int(v), round(float(s), 2)) for q, v, s in zip(rng.integers(0, 9, 900), rng.integers(0, 40, 900), rng.random(900), strict=True)]
    batches = [pa.RecordBatch.from_pydict(ann._table(tuple(map(np.array, zip(*found[a:a + 50], strict=True))))) for a in range(0, 900, 50)]
    out = [tuple(r.values()) for b in ann.merged(3, held)(iter(batches)) for r in b.to_pylist()]
    assert set(out) <= set(found) and list(ann.merged(3)(iter([])))[0].num_rows == 0

    def top(rows):
        best = {}
        for q, v, s in rows:
            best.setdefault(q, {})[v] = max(s, best.get(q, {}).get(v, 0.0))
        return {q: sorted(own.items(), key=lambda x: (-x[1], x[0]))[:3] for q, own in best.items()}

    assert top(out) == top(found)
    if held > 1000:
        assert len(out) == 9 * 3


def test_recall_on_the_given_embeddings(spark):
    """Of the true 5 nearest of every 50th vector at least 0.9 are found; what is found has its exact cosine."""
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    got: dict = {}
    for r in queries.op7_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        s = x @ x[k]
        s[k] = -2
        for j in np.lexsort((ids, -s))[:5]:
            total += 1
            if int(ids[j]) in got[int(ids[k])]:
                hits += 1
                assert abs(got[int(ids[k])][int(ids[j])] - s[j]) < 1e-9
    assert hits >= 0.9 * total
    print(f"recall {hits / total:.3f} of {total}")
