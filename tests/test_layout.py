"""Bucketed layout: parent/child joins on order_id without an exchange."""

import os
import tempfile

from conftest import SEED_AS_OF
from fetchplan.operators import aggregates as A
from fetchplan.operators import nesting
from fetchplan.plans.variants import plan_text
from fetchplan.sources.tables import write_bucketed


def test_bucketed_tables_join_without_shuffle(spark, seed):
    base = tempfile.mkdtemp(prefix="fetchplan-bucket-")
    write_bucketed(seed["orders"], "fp_orders_b", "order_id", 4, os.path.join(base, "orders"))
    write_bucketed(seed["order_details"], "fp_details_b", "order_id", 4, os.path.join(base, "details"))
    o, d = spark.table("fp_orders_b"), spark.table("fp_details_b")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_order = A.order_totals(o, d, ordered=False)
        tree = plan_text(per_order).split("== Physical Plan ==")[1].split("\n\n")[0]
        # details aggregate per order_id and join orders with no exchange at all
        assert "SortMergeJoin" in tree and "HashAggregate" in tree
        assert "Exchange" not in tree, tree
        assert sorted((r["order_id"], r["detail_count"]) for r in per_order.collect()) == \
            [(1, 2), (2, 2), (3, 3), (4, 0), (5, 2), (6, 1)]
        nested = nesting.orders_nested_join(o, d, SEED_AS_OF, 30, ordered=False)
        got = {r["order_id"]: [x["detail_id"] for x in r["details"]] for r in nested.collect()}
        assert got == {2: [3, 4], 3: [5, 6, 7], 4: [], 5: [8, 9]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql("DROP TABLE IF EXISTS fp_orders_b")
        spark.sql("DROP TABLE IF EXISTS fp_details_b")
