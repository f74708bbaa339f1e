
import os

import pytest

from fetchplan import registry
from fetchplan.plans.variants import plan_text

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data missing")


def test_look_back_pushed_to_scan(spark):
    text = plan_text(registry.QUERIES["recent_orders"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-02T00:00)" in text
    # column pruning: the status and priority columns are never read
    assert "o_orderpriority" not in text.split("ReadSchema")[1].split("\n")[0]


def test_batch_broadcasts_small_keys(spark):
    text = plan_text(registry.QUERIES["orders_nested_batch"](spark, SF))
    assert "BroadcastHashJoin LeftSemi BuildRight" in text


@pytest.mark.parametrize("name", ["counter_delta", "speedup_vs_baseline", "best_method", "time_saved", "cache_efficiency"])
def test_measurements_aggregate_by_hash(spark, name):
    tree = plan_text(registry.QUERIES[name](spark, SF)).split("\n\n")[0]
    assert "HashAggregate" in tree and "SortAggregate" not in tree and "RDDScan" not in tree


def test_summary_function_is_one_join(spark, seed):
    from fetchplan.functions.lookup_functions import register_sql_functions
    seed["orders"].createOrReplaceTempView("fp_orders")
    seed["departments"].createOrReplaceTempView("fp_departments")
    register_sql_functions(spark, "fp_orders", "fp_departments", as_of="2024-06-30 00:00:00")
    spark.createDataFrame([(71,), (1,)], "c bigint").createOrReplaceTempView("fp_ids")
    tree = plan_text(spark.sql("SELECT c, customer_order_summary(c) AS s FROM fp_ids")).split("\n\n")[0]
    assert sum("Join" in line for line in tree.split("\n")) == 1


@pytest.mark.parametrize("name", ["orders_nested_lateral", "employees_departments_lateral"])
def test_lateral_shapes_are_decorrelated(spark, name):
    text = plan_text(registry.QUERIES[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "HashJoin" in text


def test_top_k_is_take_ordered(spark):
    text = plan_text(registry.QUERIES["top_waits"](spark, SF))
    assert "TakeOrderedAndProject" in text


def test_hit_ratio_has_no_cross_join(spark):
    text = plan_text(registry.QUERIES["hit_ratio"](spark, SF))
    assert "Join" not in text


def test_department_stats_pre_aggregates(spark):
    text = plan_text(registry.QUERIES["department_stats"](spark, SF))
    # employees are aggregated below the join to departments
    join_at = text.index("BroadcastHashJoin LeftOuter")
    assert "HashAggregate" in text[join_at:]


def test_preview_is_per_task_top_k(spark):
    tree = plan_text(registry.QUERIES["order_preview"](spark, SF)).split("\n\n")[0]
    # WindowGroupLimit below the exchange: each task keeps its first rows per order
    below = tree.split("Exchange")[1]
    assert "WindowGroupLimit" in below


def test_batch_filters_children_before_shuffle(spark):
    lines = plan_text(registry.QUERIES["orders_nested_batch"](spark, SF)).split("\n\n")[0].split("\n")
    semi_at = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    # the semi join sits below (is printed after) the exchange that deals children out by page
    assert any("Exchange" in x and "Broadcast" not in x for x in lines[:semi_at])
