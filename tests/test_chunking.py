"""Paged nesting: the page size changes the pages only, and hot parents spread over tasks."""

import contextlib

import pytest
from pyspark.sql import functions as F

from conftest import SEED_AS_OF
from fetchplan.operators import nesting
from fetchplan.operators.chunking import page_counts, with_page
from fetchplan.plans.variants import plan_text
from fetchplan.sources import datagen

SHAPES = (nesting.orders_nested_join, nesting.orders_nested_batch, nesting.orders_nested_lateral)


@contextlib.contextmanager
def settings(spark, **values):
    values = {"spark.sql." + k.replace("_", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _children(df):
    out = {}
    for r in df.collect():
        ids = [x["detail_id"] for x in r["details"]]
        assert ids == sorted(ids)
        out.setdefault(r["order_id"], []).extend(ids)
    return {o: sorted(x) for o, x in out.items()}


@pytest.mark.parametrize("shape", SHAPES)
def test_order_totals_do_not_depend_on_pages(spark, shape):
    g = datagen.generate(spark, SEED_AS_OF, n_orders=300, hot_share=1 / 3)
    o, d = g["orders"], g["order_details"]
    whole = shape(o, d, SEED_AS_OF, 30, max_children=None, ordered=False)
    want = (_children(whole), sorted(nesting.flatten_nested(whole).collect()), sorted(nesting.child_rows(whole).collect()))
    assert len(want[0][1]) == 604
    for bound in (3, 100, 100_000):
        paged = shape(o, d, SEED_AS_OF, 30, max_children=bound, ordered=False)
        assert (_children(paged), sorted(nesting.flatten_nested(paged).collect()),
                sorted(nesting.child_rows(paged).collect())) == want
    flat = nesting.orders_details_flat(o, d, SEED_AS_OF, 30, max_children=3)
    assert sorted(r["detail_id"] or 0 for r in flat.collect()) == sorted(x for ids in want[0].values() for x in ids or [0])


@pytest.mark.parametrize("shape", SHAPES)
def test_no_job_runs_while_a_shape_is_built(spark, seed, shape):
    def jobs():
        return set(spark.sparkContext.statusTracker().getJobIdsForGroup(shape.__name__))

    o, d = seed["orders"].cache(), seed["order_details"].cache()
    spark.sparkContext.setJobGroup(shape.__name__, "built, then counted")
    try:
        built = shape(o, d, SEED_AS_OF, 30)
        assert not jobs()
        built.count()
        assert jobs()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _exchanges(text):
    return [x.split("]")[0] for x in text.split("Exchange ")[1:] if x.startswith("hashpartitioning(")]


@pytest.mark.parametrize("shape", SHAPES)
def test_plan_without_any_broadcast_of_parents(spark, tmp_path, shape):
    """Beyond every broadcast bound: children are filtered by the parents' keys before they are dealt out by
    page, and nothing that nests or joins the pages stands on an exchange by order alone."""
    g = datagen.generate(spark, SEED_AS_OF, n_orders=200, hot_share=1 / 3)
    for t in ("orders", "order_details"):
        g[t].write.parquet(f"{tmp_path}/{t}")
    o, d = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("orders", "order_details"))
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        tree = plan_text(shape(o, d, SEED_AS_OF, 30, ordered=False)).split("\n\n")[0]
    lines = tree.split("\n")
    depth = {i: len(x) - len(x.lstrip(" :+-")) for i, x in enumerate(lines)}
    semi = next(i for i, x in enumerate(lines) if "SortMergeJoin LeftSemi" in x)
    # what stands above the semi join: the exchange by page
    above = [i for i in range(semi) if depth[i] < depth[semi] and "Exchange" in lines[i]]
    assert above, tree
    assert "CartesianProduct" not in tree and "BroadcastNestedLoopJoin" not in tree
    outer = next(x for x in lines if "LeftOuter" in x and "BroadcastHashJoin" not in x)
    assert "SortMergeJoin" in outer or "ShuffledHashJoin" in outer


def test_hot_parent_spreads_over_tasks(spark):
    """One parent owns a third of all children: no task gets more than a part of them."""
    kids = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).cast("bigint").alias("order_id"),
        F.col("id").alias("detail_id"))
    with settings(spark, shuffle_partitions="16", adaptive_coalescePartitions_enabled="false"):
        dealt = with_page(kids, "order_id", ["detail_id"], page_counts(kids, "order_id", 100))
        per_task = dealt.filter("order_id = 1").groupBy(F.spark_partition_id()).count().collect()
        pages = dealt.filter("order_id = 1").groupBy("chunk").count().collect()
    assert len(per_task) == 16 and max(r["count"] for r in per_task) < 2500
    assert len(pages) == 100 and max(r["count"] for r in pages) < 200 and sum(r["count"] for r in pages) == 10000
    assert dealt.filter("order_id <> 1 AND chunk <> 0").count() == 0
