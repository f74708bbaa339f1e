"""Heavy keys by mergeable summaries, and pages cut along the children's order."""

import contextlib

import pytest
from pyspark.sql import functions as F

from conftest import SEED_AS_OF
from fetchplan.operators import heavy, nesting
from fetchplan.operators.chunking import page_counts, with_page
from fetchplan.plans.variants import plan_text
from fetchplan.sources import datagen


@pytest.fixture(scope="module")
def keyed(spark):
    """A hot key with a third of 30,000 rows, 20 keys of 300, many of a few, and nulls."""
    key = (F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 5 == 0, F.col("id") % 20 + 1)
           .when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 4000 + 100))
    return spark.range(30_000, numPartitions=7).select(key.cast("bigint").alias("k"), "id").cache()


def plain(df, above):
    return {(r.k, r["count"]) for r in df.groupBy("k").count().collect() if r.k is not None and r["count"] > above}


@pytest.mark.parametrize("above,items", [(250, 64), (5000, 4), (3, 1024), (3, 1), (0, 1), (50_000, 8)])
def test_heavy_keys_are_exact(keyed, above, items):
    """Whether summaries vouch for all keys, for some parts' keys, or for none."""
    assert {tuple(r) for r in heavy.heavy_keys(keyed, "k", above, items).collect()} == plain(keyed, above)


def test_summaries_vouch_only_within_their_error(keyed):
    picks = {r.part: r for r in heavy.candidates(heavy.frequent_summary(keyed, "k", 24), 300, 24).collect()}
    sizes = {r.part: r["count"] for r in keyed.where("k is not null").groupBy(heavy._part(F.col("k")).alias("part")).count().collect()}
    assert picks.keys() == sizes.keys() and {p.vouched for p in picks.values()} == {True, False}
    for part, p in picks.items():
        assert p.vouched == (2 * heavy.ERROR / heavy.summary_size(24) * sizes[part] <= 300)
        own = {k for k, n in plain(keyed.where(heavy._part(F.col("k")) == part), 300)}
        assert not p.vouched or own <= set(p["keys"])


def test_stored_summaries_merge(keyed):
    """Summaries of two halves of a table, kept as rows, serve the whole."""
    halves = [heavy.frequent_summary(keyed.where(f"id % 2 = {h}"), "k", 64) for h in (0, 1)]
    merged = heavy.merge_summaries(halves[0].unionByName(halves[1]), 64)
    assert {tuple(r) for r in heavy.heavy_keys(keyed, "k", 250, 64, merged).collect()} == plain(keyed, 250)


def test_heavy_keys_of_text_and_of_nothing(spark):
    words = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 9, "w string")
    assert [tuple(r) for r in heavy.heavy_keys(words, "w", 2).collect()] == [("a", 5)]
    assert heavy.heavy_keys(words.where("false"), "w", 0).collect() == []
    with pytest.raises(ValueError):
        heavy.heavy_keys(words, "w", 2, items=0)


@contextlib.contextmanager
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_aggregate_over_all_children(spark, tmp_path):
    """A hot order, and automatic broadcast off: every aggregate that reads the details stands above the semi join."""
    g = datagen.generate(spark, SEED_AS_OF, n_orders=200, hot_share=1 / 3)
    for t in ("orders", "order_details"):
        g[t].write.parquet(f"{tmp_path}/{t}")
    o, d = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("orders", "order_details"))
    with no_broadcast(spark):
        for shape in (nesting.orders_nested_join, nesting.orders_nested_batch, nesting.orders_nested_lateral):
            tree = plan_text(shape(o, d, SEED_AS_OF, 30, ordered=False, max_children=50)).split("\n\n")[0].split("\n")
            depth = [len(x) - len(x.lstrip(" :+-")) for x in tree]
            scans = [i for i, x in enumerate(tree) if "Scan parquet" in x]
            semi = 0
            for i in scans:
                above, at = [], depth[i]
                for k in reversed(range(i)):
                    if depth[k] < at:
                        above.append(tree[k])
                        at = depth[k]
                first = next((n for n, x in enumerate(above) if "LeftSemi" in x), None)
                if first is not None:
                    semi += 1
                    assert not any("Aggregate" in x for x in above[:first])
            assert semi >= 2
        flat = nesting.flatten_nested(nesting.orders_nested_batch(o, d, SEED_AS_OF, 30, max_children=50, ordered=False))
        want = nesting.flatten_nested(nesting.orders_nested_batch(o, d, SEED_AS_OF, 30, max_children=None, ordered=False))
        assert sorted(flat.collect()) == sorted(want.collect())


@pytest.mark.parametrize("shape", [nesting.orders_nested_join, nesting.orders_nested_batch, nesting.orders_nested_lateral])
def test_pages_are_in_order(spark, shape):
    g = datagen.generate(spark, SEED_AS_OF, n_orders=300, hot_share=1 / 3)
    paged = shape(g["orders"], g["order_details"], SEED_AS_OF, 30, max_children=40, ordered=False)
    got = {}
    for r in sorted(paged.collect(), key=lambda r: (r.order_id, r.chunk)):
        got.setdefault(r.order_id, []).append([x.detail_id for x in r.details])
    hot = max(got.values(), key=len)
    assert len(hot) > 10 and max(map(len, hot)) < 3 * 40
    for pages in got.values():
        ids = [x for p in pages for x in p]
        assert ids == sorted(ids)
    places = {(r.order_id, r.place): r.detail.detail_id for r in nesting.places_in_pages(paged).collect()}
    assert places == {(o, k + 1): x for o, pages in got.items() for k, x in enumerate([x for p in pages for x in p])}


def test_cuts_follow_all_columns(spark):
    """Children that tie in the first column are cut by the next; equal children share a page."""
    kids = spark.range(6000).select(F.lit(1).alias("k"), F.lit(None).cast("int").alias("a"), (F.col("id") % 3000).alias("b"))
    pages = page_counts(kids, "k", 500)
    cuts = pages.cuts.first()._cuts
    assert len(cuts) == 11 and [c.b for c in cuts] == sorted(c.b for c in cuts)
    sizes = {r.chunk: r["count"] for r in with_page(kids, "k", ["a", "b"], pages).groupBy("chunk").count().collect()}
    assert sorted(sizes) == list(range(12)) and 250 < min(sizes.values()) and max(sizes.values()) < 1000
    per_value = with_page(kids, "k", ["a", "b"], pages).groupBy("b").agg(F.countDistinct("chunk").alias("n"))
    assert per_value.where("n > 1").count() == 0
