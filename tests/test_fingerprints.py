"""Order-free fingerprints of results, and exact differences where they differ."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fetchplan.plans.variants import compare_pair, fingerprints, variants_agree

SCHEMA = "a int, b string, c decimal(10,2), d timestamp_ntz, e double"
ROWS = [(1, "x", Decimal("1.50"), dt.datetime(2024, 1, 1), 0.5), (None, "x", None, None, None), (1, None, None, None, None),
        (1, "x", Decimal("1.50"), dt.datetime(2024, 1, 1), 0.5), (2, "", Decimal("0"), None, -0.0)]


def prints(spark, **variants):
    return {r.variant: tuple(r)[1:] for r in fingerprints({k: spark.createDataFrame(v, SCHEMA) for k, v in variants.items()}).collect()}


def test_order_and_partitions_do_not_show(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = fingerprints({"a": df, "b": df.orderBy("a").repartition(7), "c": df.select("e", "d", "c", "b", "a").coalesce(1)}).collect()
    assert len({tuple(r)[1:] for r in got}) == 1 and got[0].row_count == 5


@pytest.mark.parametrize("change", [
    lambda r: r[:-1], lambda r: [*r, r[0]], lambda r: [*r[1:], (1, "x", Decimal("1.51"), *r[0][3:])],
    lambda r: [r[0], (None, None, None, None, None), *r[2:]], lambda r: [(r[0][0], "x ", *r[0][2:]), *r[1:]]])
def test_any_change_shows(spark, change):
    got = prints(spark, a=ROWS, b=change(ROWS))
    assert got["a"] != got["b"]


def test_nulls_keep_their_column(spark):
    """A hash that passes over nulls would take these for equal."""
    frames = [spark.createDataFrame([r], "a int, b int, s struct<x: int, y: int>") for r in ((1, None, (1, None)), (None, 1, (1, None)), (1, None, (None, 1)))]
    got = fingerprints(dict(zip("abc", frames, strict=True))).collect()
    assert len({tuple(r)[1:] for r in got}) == 3


def test_agreeing_pairs_shuffle_a_row_a_task(spark):
    """Agreeing variants are read once and never grouped by their rows; differing ones are counted exactly."""
    df = spark.range(1000, numPartitions=4).selectExpr("id % 10 AS x", "id AS y")
    group = "agreeing-pairs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = variants_agree({"a": df, "b": df.repartition(3), "c": df.where("y > 4"), "d": df.unionAll(df.where("x = 1"))})
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [(r.variant_b, r.rows_b, r.only_in_a, r.only_in_b, r.agree) for r in out.orderBy("variant_b").collect()] == [
        ("b", 1000, 0, 0, True), ("c", 995, 5, 0, False), ("d", 1100, 0, 100, False)]
    plan = variants_agree({"a": df, "b": df.repartition(3)})._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Range" not in plan


def test_other_types_are_compared_by_value(spark):
    a, b = spark.range(5).selectExpr("cast(id AS int) AS x"), spark.range(5).selectExpr("id AS x")
    assert compare_pair(a, b).first().agree


def test_empty_variants(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    none = df.where("false")
    assert tuple(compare_pair(none, none).first())[2:] == (0, 0, 0, 0, True)
    assert tuple(compare_pair(df, none).first())[2:] == (5, 0, 5, 0, False)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["", "a", None])), max_size=6), st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["", "a", None])), max_size=6))
def test_pairs_are_multiset_differences(spark, a, b):
    frames = [spark.createDataFrame(x, "x int, y string") for x in (a, b)]
    got = compare_pair(*frames).first()
    left, rest = [], list(b)
    for x in a:
        rest.remove(x) if x in rest else left.append(x)
    assert tuple(got)[2:] == (len(a), len(b), len(left), len(rest), not left and not rest)
