"""Language ID, quality classifier and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.llm_helpers import DOCUMENTS, corpus, roots, shingles
from pyspark.sql import functions as F

import corpus_pipeline
from fetchplan.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def plain_phrases(text: bytes, reference: bytes) -> int:
    """Greedy cross-parsing: longest match from here, then on."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in reference:
            end += 1
        at = max(end - 1, at + 1)
        n += 1
    return n


def test_long_texts_are_parsed_in_one_piece():
    """Texts of 100,000 bytes, one of which never falls in at a lane's start, equal a plain cross-parse."""
    rng = random.Random(7)
    references = (("p", b"a" * 300 + bytes(rng.choice(b"abcd ") for _ in range(400))), ("q", bytes(rng.choice(b"bcdef ") for _ in range(700))))
    p = langid.Parser(references)
    texts = ["".join(rng.choice("abcdef ") for _ in range(100_000)), "a" * 100_000, ("abc " * 9 + "z") * 2800, "b" * 5000]
    data, offsets = langid.normalise(texts)
    got = p.phrases(data, offsets)
    for k in range(len(texts)):
        body = data[offsets[k]:offsets[k + 1]].tobytes()
        assert got[k].tolist() == [plain_phrases(body, r) for _, r in references]


def test_phrases_equal_a_plain_cross_parse():
    rng = random.Random(6)
    references = tuple((k, "".join(rng.choice(a) for _ in range(300)).encode()) for k, a in (("p", "abcd "), ("q", "cdéf ")))
    p = langid.Parser(references)
    texts = ["".join(rng.choice("abcdéfg ") for _ in range(rng.randrange(0, 400))) for _ in range(60)] + ["", "zzz", "a", "z" * 50]
    data, offsets = langid.normalise(texts)
    got = p.phrases(data, offsets)
    for k, x in enumerate(texts):
        body = data[offsets[k]:offsets[k + 1]].tobytes()
        assert got[k].tolist() == [plain_phrases(body, r) for _, r in references]
    for lane in (1, 2, 7, 64):
        assert p.phrases(data, offsets, lane=lane).tolist() == got.tolist()


def test_lanes_add_at_most_one_phrase(monkeypatch):
    rng = random.Random(7)
    references = (("p", "".join(rng.choice("abc ") for _ in range(500)).encode()),)
    data, offsets = langid.normalise(["".join(rng.choice("abc ") for _ in range(5000))])
    whole = plain_phrases(data.tobytes(), references[0][1])
    monkeypatch.setattr(langid, "LANE", 500)
    got = langid.Parser(references).phrases(data, offsets)[0, 0]
    assert whole <= got <= whole + -(-len(data) // 500)


def test_identify(docs, no_docs):
    references = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    assert [name for name, _ in references] == ["aa", "zz"] and all(len(r) <= langid.SAMPLE_BYTES + langid.SAMPLE_TEXTS for _, r in references)
    got = langid.identify(docs.withColumn("Score", F.lit("x")), references)
    assert got.columns == [*docs.columns, "lang_pred", "score"]
    for r in got.collect():
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("aa", "zz") and 0 <= r.score <= 1
            if r.doc_id and 10 <= r.doc_id < 40 or r.doc_id == 90:
                assert r.lang_pred == r.lang
    assert langid.learn(no_docs) == () and langid.identify(no_docs, references).collect() == []
    assert {r.lang_pred for r in langid.identify(docs, ()).collect()} == {"und"}


def test_held_out(spark):
    rows = spark.createDataFrame([(k,) for k in range(300)] + [(None,)], "doc_id long")
    for r in rows.withColumn("h", langid.held_out(F.col("doc_id"))).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").select("doc_id", "lang").collect()}
    got = [r for r in queries.QUERIES["op9_language_id"](spark, SF).collect() if r.held_out]
    assert len(got) > 150 and sum(r.lang_pred == langs[r.doc_id] for r in got) >= 0.98 * len(got)


def test_ordinal_fit_orders_grades():
    """Shared weights and ordered thresholds recover grades that fall with the number of defects."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 40, 12)) for _ in range(1500)]
    defects = np.array([(r < 10).sum() for r in rows])
    grades = 2 - np.digitize(defects, [1.5, 3.5])
    m = quality.fit_rows(rows, grades, 3, bits=6)
    assert np.all(np.diff(m.thresholds) > 0) and np.all(m.weights <= 0)
    tails = m.tails(np.array([m.weights[r].sum(dtype=np.float64) for r in rows]))
    assert np.all(tails[:, 0] >= tails[:, 1])
    assert np.mean((tails[:, 1] >= 0.5) == (grades == 2)) > 0.93 and np.mean((tails[:, 0] >= 0.5) == (grades >= 1)) > 0.93
    assert m.tails(np.zeros(1))[0, 1] > 0.5  # nothing speaks against it


def test_grouped_rows_fit_as_single_ones():
    """Equal rows are summed: doubling every row changes nothing."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 8, 4)) for _ in range(400)]
    grades = np.array([0 if 3 in r else 1 for r in rows])
    one, two = (quality.fit_rows(rows * k, np.tile(grades, k), 2, bits=3, min_z=0.0, min_docs=1, rounds=200) for k in (1, 2))
    assert np.allclose(one.weights, two.weights, atol=1e-3) and np.allclose(one.thresholds, two.thresholds, atol=1e-3)


def test_classify(spark, docs, no_docs):
    ratings = spark.createDataFrame([(10 + k, k % 3) for k in range(30)] + [(10, 2), (11, None), (None, 1), (999, 1)], "doc_id long, grade int")
    model = quality.fit(docs, ratings, bits=12)
    got = quality.classify(docs.withColumn("SELECTED", F.lit(1)), model)
    assert got.columns == [*docs.columns, "expected_grade", "tail_probability", "selected"]
    for r in got.collect():
        if not r.text:
            assert (r.expected_grade, r.tail_probability, r.selected) == (0.0, 0.0, False)
        assert 0 <= r.tail_probability <= r.expected_grade <= 2 and r.selected == (r.tail_probability >= 0.5)
    assert quality.classify(no_docs, model).collect() == []
    untrained = quality.fit(docs, ratings.where("false"), bits=12)
    assert {r.tail_probability for r in quality.classify(docs, untrained).collect() if r.text} == {0.5}
    assert quality.fit(no_docs, ratings, bits=12).thresholds.tolist() == [0.0, 0.0]


def test_quality_of_unseen_documents(spark):
    """Fitted on the ratings of even ids, the tail probability tells the ratings of odd ids."""
    docs, labels = queries.table(spark, "/root/testdata/sf0.1", "documents"), queries.table(spark, "/root/testdata/sf0.1", "labels")
    grade = quality.grade(F.col("quality"), F.col("toxic"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0").select("doc_id", grade.alias("grade")))
    odd = labels.where("doc_id % 2 = 1").select("doc_id", grade.alias("grade"))
    seen = Counter((r.grade, r.selected) for r in quality.classify(docs, model, keep=["doc_id"]).join(odd, "doc_id").collect())
    assert seen[2, True] >= 0.98 * (seen[2, True] + seen[2, False])
    for g, least in ((0, 0.97), (1, 0.75)):  # a quarter of the toxic ratings show none of the words that tell
        assert seen[g, False] >= least * (seen[g, True] + seen[g, False])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(10 + k, 1, 0) for k in range(20)] + [(30 + k, 0, 0) for k in range(5)] + [(35, 1, None), (36, None, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(corpus(), DOCUMENTS).write.parquet(f"{out}/documents.parquet")
    return out


def test_stages_keep_columns_and_take_odd_rows(spark, folder, docs, no_docs):
    wide = docs.select("*", *[F.lit("x").alias(c) for c in ("lang_pred", "Score", "selected", "component_id", "n_shingles", "a b", "n")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, folder)
        assert out.columns == wide.columns
        kept = Counter(map(tuple, out.collect()))
        assert not kept - Counter(map(tuple, wide.collect()))
        empty = stage(spark, no_docs, folder)
        assert empty.columns == no_docs.columns and empty.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, folder).collect() == []


def test_language_stage_rejects_texts_without_language(spark, folder, docs):
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, folder).collect()}
    assert not kept & {1, 2, 3, 7} and {10 + k for k in range(30)} | {50, 70, 90} <= kept


def test_near_duplicate_stage_keeps_one_of_each_group(spark, folder, docs):
    """Groups are of texts: a repeated id keeps each of its texts that nothing else is linked to."""
    texts = {(r.doc_id, r.text): shingles(r.text, 5) for r in docs.collect() if r.doc_id is not None}
    nodes = list(texts)
    pairs = [(k, m) for k, a in enumerate(nodes) for m, b in enumerate(nodes[:k])
             if texts[a] and texts[b] and 100 * len(texts[a] & texts[b]) >= 80 * len(texts[a] | texts[b])]
    groups = Counter(roots(range(len(nodes)), pairs).values())
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()]
    group = roots(range(len(nodes)), pairs)
    got = Counter(group[nodes.index(x)] for x in kept if x[0] is not None)
    assert set(got) == set(groups) and set(got.values()) == {1} and sum(x[0] is None for x in kept) == 1
    ids = {g: min(nodes[k][0] for k in range(len(nodes)) if group[k] == g) for g in groups}
    assert all(ids[group[nodes.index(x)]] == x[0] for x in kept if x[0] is not None)


def test_unlinked_texts_of_one_id_all_stay(spark, folder):
    words = [f"w{k}" for k in range(60)]
    rows = [(5, " ".join(words)), (3, " ".join(words[:-1] + ["end"])), (5, "a text found nowhere else at all " * 3), (5, "a text found nowhere else at all " * 3),
            (7, None), (7, ""), (7, "one"), (8, "one"), (None, "one")]
    given = spark.createDataFrame([(i, t, "aa", f"s{k}", k) for k, (i, t) in enumerate(rows)], DOCUMENTS)
    kept = sorted((r.doc_id or 0, r.text or "-") for r in corpus_pipeline.near_duplicates(spark, given, folder).collect())
    assert kept == sorted([(3, rows[1][1]), (5, rows[2][1]), (7, "-"), (7, "-"), (7, "one"), (0, "one")])


def test_many_rows_of_one_id_and_text(spark, folder):
    many = spark.range(10_000, numPartitions=6).select(F.lit(4).cast("long").alias("doc_id"), F.lit("the same " * 20).alias("text"), F.lit("aa").alias("lang"),
                                                       F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    assert [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, many, folder).collect()] == [(4, "the same " * 20)]


def test_short_texts_that_fit_two_languages_stay(spark, folder):
    rows = [(k, "bako lume tira sona" if k % 2 else "grast schön qip wyrm", "aa" if k % 2 else "zz", "s", 1) for k in range(20)] + [(50, "x", None, "s", 1), (51, "Re.", None, "s", 1)]
    kept = {r.doc_id for r in corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCUMENTS), folder).collect()}
    assert {50, 51} <= kept


def test_run_is_its_stages(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, folder).collect(), DOCUMENTS)
    want = {(r.doc_id, r.doc_tokens) for r in corpus_pipeline.packed(spark, rows, folder).collect()}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r.doc_id, r.doc_tokens) for r in got} == want and want
    assert sum(r.length for r in got) == sum(n for _, n in want)


def plain_fit(rows, grades, n_grades, rounds, ridge=1e-6, rate=0.1):
    """The likelihood written out, its gradient by differences, and the same steps; thresholds are the first and log gaps."""
    names = sorted({b for r in rows for b in r})
    count = Counter(grades)
    w = [count[g] ** -0.5 for g in grades]
    w = [x / sum(w) for x in w]

    def cuts(theta):
        out = [theta[len(names)]]
        for gap in theta[len(names) + 1:]:
            out.append(out[-1] + np.exp(gap))
        return out

    def loss(theta):
        total = ridge / 2 * sum(x * x for x in theta[:len(names)])
        for r, g, weight in zip(rows, grades, w, strict=True):
            latent = sum(theta[names.index(b)] for b in r)
            tail = [1.0, *[1 / (1 + np.exp(-(latent - c))) for c in cuts(theta)], 0.0]
            total -= weight * np.log(tail[g] - tail[g + 1])
        return total

    theta = np.array([0.0] * len(names) + [-1.0] + [0.0] * (n_grades - 2))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        step = np.eye(len(theta)) * 1e-6
        g = np.array([(loss(theta + e) - loss(theta - e)) / 2e-6 for e in step])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        theta[:len(names)] = np.minimum(theta[:len(names)], 0.0)
    return dict(zip(names, theta, strict=False)), cuts(theta)


@pytest.mark.parametrize("n_grades", [2, 3, 4])
def test_fit_follows_the_likelihood(n_grades):
    """Weights and thresholds as from the written-out likelihood and differences instead of its derivative."""
    rng = random.Random(n_grades)
    rows = [np.array(sorted(rng.sample(range(12), rng.randrange(1, 6)))) for _ in range(40)]
    grades = [max(0, n_grades - 1 - sum(b < 3 for b in r.tolist()) - (rng.random() < 0.2)) for r in rows]
    model = quality.fit_rows(rows, np.array(grades), n_grades, bits=4, rounds=25, min_docs=0, min_z=-1.0)
    weights, thresholds = plain_fit([r.tolist() for r in rows], grades, n_grades, 25)
    assert np.allclose(model.weights[sorted(weights)], [weights[b] for b in sorted(weights)], atol=2e-3)
    assert np.allclose(model.thresholds, thresholds, atol=2e-3) and list(model.thresholds) == sorted(model.thresholds)


def test_scores_equal_plain_sums(spark, docs, folder):
    """Grades and tails of every text from its features' weights, one after another; the stage keeps just the selected."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade")))
    bits = int(np.log2(len(model.weights)))
    got = quality.classify(docs, model, least=0.5).collect()
    assert len(got) == docs.count()
    kept = Counter()
    for r in got:
        if r.text:
            latent = sum(float(model.weights[b]) for b in quality.features(bits).of(r.text))
            tails = [1 / (1 + np.exp(-(latent - c))) for c in model.thresholds]
            assert abs(r.expected_grade - sum(tails)) < 1e-4 and abs(r.tail_probability - tails[-1]) < 1e-4
            if abs(tails[-1] - 0.5) > 1e-4:
                assert r.selected == (tails[-1] >= 0.5)
        if r.selected:
            kept[(r.doc_id, r.text)] += 1
    assert Counter((r.doc_id, r.text) for r in corpus_pipeline.quality_filter(spark, docs, folder).collect()) == kept
