"""N-gram join, LM scores, components and hash tables against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.llm_helpers import roots, shingles, split
from pyspark.sql import functions as F

from fetchplan.llm import columns, hash_tables, hashing, lm, ngram_join
from fetchplan.llm.columns import buffers
from fetchplan.llm.components import connected_components
from fetchplan.plans.variants import plan_text


def test_words_and_ngrams_hash_as_their_text():
    texts = ["A b\tc\x0bD", "", "  ", "a B c d", "x\x00y x\x00y", "é É é", "w" * 9000 + " a"] + ["q " * 50] * 3
    old, hashing.STEP = hashing.STEP, 16
    try:
        data, offsets = buffers(pa.array(texts))
        words, ends = hash_tables.text_words(data, offsets)
    finally:
        hashing.STEP = old
    want = [split(x) for x in texts]
    assert hashing.count_words(data, offsets) == len(words)
    assert np.diff(ends).tolist() == [len(w) for w in want]
    flat = [w for x in want for w in x]
    assert len({(h, w) for h, w in zip(words.tolist(), flat, strict=True)}) == len(set(flat)) == len(set(words.tolist()))
    x, at = lm.grams(words, ends, 2)
    pairs = [p for w in want for p in zip(w, w[1:], strict=False)]
    assert len(set(zip(x.tolist(), pairs, strict=True))) == len(set(pairs)) == len(set(x.tolist()))


def test_packed_tables_round_trip():
    rng = np.random.default_rng(0)
    h = np.unique(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    c = rng.integers(1, 2**20, len(h))
    got = hash_tables.unpack(hash_tables.pack(h, c), len(h))
    assert got[0].tolist() == h.tolist() and got[1].tolist() == c.tolist()
    ends = hash_tables.range_ends(7)
    assert int(ends[-1]) == 2**64 - 1 and len(ends) == 7


@pytest.mark.parametrize("local", [1_000_000, 7])
def test_components(spark, local):
    """Whether one task finishes, or stars do."""
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(500, 500 + k) for k in range(1, 40)] + [(7, 7), (1, 2), (2, 1)]
    pairs += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(80)]
    rows = spark.createDataFrame([*pairs, (None, 3), (3, None)], "a long, b long")
    got = {r.node: r.component for r in connected_components(rows, local=local).collect()}
    want = roots({x for p in pairs for x in p}, pairs)
    alone = {x for x in want if not any(x in p and p[0] != p[1] for p in pairs)}
    assert got == {x: r for x, r in want.items() if x not in alone}
    assert connected_components(rows.where("false"), local=local).collect() == []


def test_neighbours_are_contracted_by_the_task_that_finds_them(spark, monkeypatch):
    """pipeline: a task of the near-duplicate stage needs one Python worker; two steps in a row would need two."""
    given = []

    def components(edges, a="a", b="b", local=7, contracted=False):
        given.append((plan_text(edges), contracted))
        return connected_components(edges, a, b, local, contracted)

    monkeypatch.setattr(ngram_join, "connected_components", components)
    rows = [(k, f"one two three four five six seven eight nine {k // 3}") for k in range(60)]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), percent=60).collect()}
    plan, contracted = given[0]
    assert contracted and plan.count(") MapInArrow") // 2 <= 1
    assert set(got.values()) == {0}


def test_texts_are_read_in_blocks():
    values = pa.array(["ab", None, "", "é" * 10, "c"])
    assert list(columns.text_blocks(values, 5)) == [(0, 3, ["ab", "", ""]), (3, 4, ["é" * 10]), (4, 5, ["c"])]
    assert list(columns.text_blocks(pa.array([], pa.string()), 5)) == []


@pytest.mark.parametrize("n,percent,block", [(4, 85, 512), (5, 80, 3), (2, 50, 2)])
def test_jaccard_join(docs, n, percent, block):
    """Components, set sizes and link counts as from all pairs; small blocks split the groups."""
    rows = [(r.doc_id, shingles(r.text, n)) for r in docs.collect()]
    links, pairs = Counter(), []
    for a in range(len(rows)):
        for b in range(a):
            (i, x), (j, y) = rows[a], rows[b]
            if x and y and i is not None and j is not None and 100 * len(x & y) >= percent * len(x | y):
                links[a] += 1
                links[b] += 1
                pairs.append((i, j))
    root = roots({i for i, _ in rows if i is not None}, pairs)
    got = ngram_join.jaccard_join(docs.withColumn("component_id", F.lit("x")), n=n, percent=percent, block=block,
                                  bucket_bytes=20_000, range_rows=500).collect()
    want = sorted((-1 if i is None else i, len(x), -1 if i is None else root[i], links[k]) for k, (i, x) in enumerate(rows))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id, r.n_links)
                  for r in got) == want


def test_jaccard_join_of_nothing(docs, no_docs):
    assert ngram_join.jaccard_join(no_docs).collect() == []
    got = ngram_join.jaccard_join(docs.where("doc_id in (1, 2, 3)")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == [(1, 0, 1, 0), (2, 0, 2, 0), (3, 0, 3, 0)]


def test_equal_size_bound_is_kept():
    """Exactly at the bound two sets link, one item short they don't."""
    a = np.arange(100, dtype=np.uint64)
    for shared, want in ((92, 1), (91, 0)):  # 92 / 108 >= 0.85 > 91 / 109
        b = np.concatenate([a[:shared], np.arange(1000, 1100 - shared, dtype=np.uint64)])
        i, _ = ngram_join.block_links([a, b], np.arange(2), np.arange(2), 85)
        assert len(i) == want


def plain_scores(rows, order, alpha, leave_out):
    own = [[Counter(zip(*(w[k:] for k in range(n)), strict=False)) for n in range(1, order + 1)] for w in rows]
    total = [sum((o[n] for o in own), Counter()) for n in range(order)]
    size = sum(map(len, rows))
    for k, w in enumerate(rows):
        def count(g, k=k):
            return total[len(g) - 1][g] - (own[k][len(g) - 1][g] if leave_out else 0)

        score = 0.0
        for at in range(len(w)):
            p = max(count((w[at],)), 0.5) / max(size - (len(w) if leave_out else 0), 1)
            for n in range(2, min(order, at + 1) + 1):
                g = tuple(w[at - n + 1:at + 1])
                p = count(g) / count(g[:-1]) if count(g) > 0 else alpha * p
            score += math.log(p)
        yield score


@pytest.mark.parametrize("order,leave_out", [(3, True), (3, False), (1, True), (4, True)])
def test_backoff_scores(docs, order, leave_out):
    some = docs.where("doc_id is null or doc_id != 90")
    rows = [(r.doc_id, split(r.text)) for r in some.collect()]
    want = sorted((-1 if i is None else i, len(w), round(s, 6))
                  for (i, w), s in zip(rows, plain_scores([w for _, w in rows], order, 0.4, leave_out), strict=True))
    got = lm.backoff_scores(some.withColumn("bucket", F.lit("x")), order=order, leave_out=leave_out, bucket_bytes=10_000,
                            range_rows=300).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, round(r.log_score, 6)) for r in got) == want
    for r in got:
        assert (r.mean_log_score is None) == (r.n_words == 0)
        assert r.mean_log_score is None or abs(r.mean_log_score * r.n_words - r.log_score) < 1e-6
        assert 0 <= r.n_full <= r.n_words


def test_backoff_scores_of_nothing(no_docs):
    assert lm.backoff_scores(no_docs).collect() == []


def test_ten_thousand_rows_equal_in_id_and_text(spark):
    """Rows alike in id and text, beside a few others: each row has its result, links and counts are whole."""
    many = spark.range(10_000, numPartitions=5).select(F.lit(4).cast("long").alias("doc_id"), F.lit("the same five words again").alias("text"))
    docs = many.unionByName(spark.createDataFrame([(3, "the same five words again"), (9, "nothing alike in here")], "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.jaccard_join(docs, bucket_bytes=50_000, range_rows=2000).collect())
    assert got == {(4, 2, 3, 10_000): 10_000, (3, 2, 3, 10_000): 1, (9, 1, 9, 0): 1}
    scores = lm.backoff_scores(docs, bucket_bytes=50_000, range_rows=2000).collect()
    own = {(r.doc_id, r.n_words, r.n_full, round(r.log_score, 9)) for r in scores}
    assert Counter(r.doc_id for r in scores) == {4: 10_000, 3: 1, 9: 1} and len(own) == 3
    size = 5 * 10_001 + 4
    alike = math.log(10_000 / (size - 5))  # every word of the other copies stands where it does here
    assert all(abs(r.log_score - alike) < 1e-6 for r in scores if r.doc_id != 9)
