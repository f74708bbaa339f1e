"""Golden results on the seed tables, worked out by hand (FIXTURES.md section 2)."""

from decimal import Decimal

from conftest import SEED_AS_OF, rows
from fetchplan.functions.lookup_functions import customer_order_summary
from fetchplan.operators import aggregates as A
from fetchplan.operators import lookups, nesting

D = Decimal


def test_look_back_inclusive(seed):
    o = seed["orders"]
    assert [r[0] for r in rows(lookups.recent_orders(o, SEED_AS_OF, 30), "order_id")] == [2, 3, 4, 5]
    assert [r[0] for r in rows(lookups.recent_orders(o, SEED_AS_OF, 31), "order_id")] == [2, 3, 4, 5, 6]


def test_three_shapes_same_nesting(seed):
    o, d = seed["orders"], seed["order_details"]
    for fn in (nesting.orders_nested_join, nesting.orders_nested_batch, nesting.orders_nested_lateral):
        got = [(r["order_id"], r["chunk"], [x["detail_id"] for x in r["details"]]) for r in fn(o, d, SEED_AS_OF, 30).collect()]
        assert got == [(2, 0, [3, 4]), (3, 0, [5, 6, 7]), (4, 0, []), (5, 0, [8, 9])], fn.__name__


def test_order_totals_of_nested_rows(seed):
    nested = nesting.orders_nested_batch(seed["orders"], seed["order_details"], SEED_AS_OF, 30)
    got = {r["order_id"]: (r["detail_count"], r["detail_amount"], r["quantity_sum"], r["product_quantity_sum"])
           for r in nesting.flatten_nested(nested).collect()}
    assert got == {2: (2, D("18.50"), 5, 2513), 3: (3, D("112.40"), 6, 3017), 4: (0, D("0.00"), 0, 0), 5: (2, D("79.50"), 7, 3527)}


def test_customer_sales(seed):
    got = rows(A.customer_sales(seed["orders"], SEED_AS_OF, 30), "customer_id", "order_count", "total_sales")
    assert got == [(71, 1, D("99.90")), (72, 2, D("78.50")), (73, 1, D("7.25"))]


def test_monthly_sales(seed):
    got = rows(A.monthly_sales(seed["orders"], SEED_AS_OF, 180))
    assert got == [("2024-03", 1, D("42.00"), 1), ("2024-05", 2, D("23.50"), 2), ("2024-06", 3, D("167.15"), 3)]


def test_department_stats_nulls_first(seed):
    got = rows(A.department_stats(seed["departments"], seed["employees"]))
    assert got == [("Garden", 0, None, None, None), ("Shipping", 1, None, None, None),
                   ("Print", 2, 4000.0, D("3900.00"), D("4100.00")), ("Binding", 2, 3000.5, D("2900.50"), D("3100.50")),
                   ("Archive", 1, 2500.0, D("2500.00"), D("2500.00"))]


def test_department_headcount(seed):
    got = rows(A.department_headcount(seed["departments"], seed["employees"]), "department_id", "employee_count")
    assert got == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 1), (6, 0)]


def test_product_revenue(seed):
    got = rows(A.product_revenue(seed["order_details"], seed["orders"], SEED_AS_OF, 60, 10),
               "product_id", "total_quantity", "total_revenue", "unique_buyers")
    assert got == [(504, 3, D("99.90"), 1), (505, 5, D("60.00"), 1), (501, 4, D("40.00"), 2), (503, 5, D("13.00"), 2)]


def test_order_totals_computed_not_stored(seed):
    got = rows(A.order_totals(seed["orders"], seed["order_details"]), "order_id", "detail_count", "calculated_total")
    assert got == [(1, 2, D("42.00")), (2, 2, D("18.50")), (3, 3, D("112.40")), (4, 0, None), (5, 2, D("79.50")), (6, 1, D("5.00"))]


def test_customer_summary(spark, seed):
    ids = spark.createDataFrame([(71,), (72,), (1,)], "customer_id bigint")
    got = dict(rows(customer_order_summary(ids, seed["orders"], SEED_AS_OF, 90)))
    assert got == {71: "Orders: 1, Total: $99.9", 72: "Orders: 2, Total: $78.5", 1: "Orders: 0, Total: $"}
