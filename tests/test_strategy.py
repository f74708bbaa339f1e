"""Broadcast only behind a checked size in bytes, a shuffle join beyond it."""

import datetime

import pytest

from fetchplan.plans.strategy import bounded_broadcast, key_filtered, row_bytes
from fetchplan.plans.variants import plan_text


def _join_plan(spark, side):
    big = spark.range(100_000).withColumnRenamed("id", "k")
    return plan_text(big.join(side, "k", "left_semi"))


def test_bound_in_bytes(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = spark.range(50).withColumnRenamed("id", "k")
        assert row_bytes(side.schema) == 32
        assert "BroadcastHashJoin" in _join_plan(spark, bounded_broadcast(side, 50 * 32))
        text = _join_plan(spark, bounded_broadcast(side, 50 * 32 - 1))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_rows_without_a_bound_are_refused(spark):
    with pytest.raises(ValueError):
        bounded_broadcast(spark.createDataFrame([("a",)], "k string"))


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from fetchplan.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_key_filter_drops_rows_before_the_shuffle(spark):
    """keys whose estimate is too large to broadcast no longer make the semi join shuffle every row."""
    from fetchplan.operators import lookups, nesting

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        rows = spark.range(20_000).selectExpr("if(id % 5000 = 1, null, id % 9000) AS k", "id AS v")
        keys = spark.range(9_000).selectExpr("if(id = 8, null, id) AS k").where("k % 300 = 7 or k is null or k < 0")
        wide = keys.unionByName(spark.range(500).selectExpr("-id - 1 AS k"))
        left = key_filtered(rows, wide, "k")
        want = sorted(map(tuple, rows.join(wide.distinct(), "k", "left_semi").collect()))
        assert left.count() < 200 and len(want) > 60
        assert sorted(map(tuple, left.join(wide, "k", "left_semi").collect())) == want
        assert sorted(map(tuple, lookups._key_filter(rows, "k", wide).collect())) == want
        # other types hash otherwise, and a small side is broadcast anyway: rows stay
        assert key_filtered(rows, wide.selectExpr("cast(k AS int) AS k"), "k") is rows
        assert key_filtered(rows, spark.range(3).selectExpr("id AS k"), "k") is rows
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert key_filtered(rows, wide, "k") is rows
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
        assert key_filtered(rows, wide.where("false"), "k").join(wide.where("false"), "k", "left_semi").count() == 0
        orders = spark.range(2_000).selectExpr("id AS order_id", "id AS customer_id", "cast(1 AS decimal(12,2)) AS total_amount", "'F' AS status",
                                               "timestamp_ntz'2024-01-01' - make_dt_interval(cast(id AS int)) AS order_date")
        details = spark.range(6_000).selectExpr("id % 2000 AS order_id", "cast(id AS int) AS line_number", "1 AS quantity")
        nested = nesting.orders_nested_batch(orders, details, datetime.datetime(2024, 1, 1), 30, ["line_number", "quantity"], ordered=False)
        assert "bit_get" in plan_text(nested)
        got = {r.order_id: len(r.details) for r in nested.collect()}
        assert set(got.values()) == {3} and len(got) in (30, 31)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
