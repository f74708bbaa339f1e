"""Edge fixtures (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SEED_AS_OF, rows
from fetchplan.functions import scalar as X
from fetchplan.operators import aggregates as A
from fetchplan.operators import limits as L
from fetchplan.operators import lookups, nesting
from fetchplan.operators import quality as Q
from fetchplan.sources.tables import DEPARTMENTS, EMPLOYEES, ORDERS


def _orders(spark, data):
    return spark.createDataFrame(data, ORDERS)


def test_childless_order_everywhere(spark, seed):
    extra = _orders(spark, [(7, 75, "customer 75", dt.datetime(2024, 6, 18), Decimal("10.00"), "OPEN")])
    o = seed["orders"].unionByName(extra)
    d = seed["order_details"]
    for fn in (nesting.orders_nested_join, nesting.orders_nested_batch, nesting.orders_nested_lateral):
        got = {r["order_id"]: r["details"] for r in fn(o, d, SEED_AS_OF, 30).collect()}
        assert got[7] == [] and got[4] == [], fn.__name__
    flat = rows(nesting.orders_details_flat(o, d, SEED_AS_OF, 30), "order_id", "detail_id")
    assert (7, None) in flat and (4, None) in flat
    tot = {r[0]: (r[1], r[2]) for r in rows(A.order_totals(o, d), "order_id", "detail_count", "calculated_total")}
    assert tot[7] == (0, None)
    prev = {r["order_id"]: r for r in L.order_preview(o, d, SEED_AS_OF, 30, n=5, per_order=3).collect()}
    assert prev[7]["more_details"] == 0 and prev[7]["shown_details"] == ""


def test_cutoff_to_the_second(spark):
    cut = SEED_AS_OF - dt.timedelta(days=30)
    data = [(1, 1, "a", cut, None, None), (2, 1, "a", cut - dt.timedelta(seconds=1), None, None),
            (3, 1, "a", cut + dt.timedelta(seconds=1), None, None), (4, 1, "a", None, None, None),
            (5, 1, "a", SEED_AS_OF + dt.timedelta(days=1), None, None)]
    got = [r[0] for r in rows(lookups.recent_orders(_orders(spark, data), SEED_AS_OF, 30), "order_id")]
    assert got == [1, 3, 5]


def _depts(spark, data):
    return spark.createDataFrame(data, DEPARTMENTS)


def _emps(spark, data):
    return spark.createDataFrame(
        [(i, "f", "l", f"e{i}@x", d, s, None) for i, d, s in data], EMPLOYEES)


def test_null_location_and_dangling_department(spark):
    d = _depts(spark, [(1, "Sales", "Location 1"), (9, "Ops", None)])
    e = _emps(spark, [(1, 1, Decimal("1.00")), (2, 9, Decimal("1.00")), (3, None, None), (4, 99, None)])
    for fn in (nesting.employees_departments_join, nesting.employees_departments_batch,
               nesting.employees_departments_lateral):
        got = {r["employee_id"]: r["department"] for r in fn(e, d).collect()}
        assert got[1]["department_name"] == "Sales"
        assert got[2] is None and got[3] is None and got[4] is None, fn.__name__
    labels = dict(rows(L.employee_preview(e, d, 10), "employee_id", "department_label"))
    assert labels == {1: "Sales (Location 1)", 2: "unknown", 3: "unknown", 4: "unknown"}
    orphans = [r[0] for r in rows(Q.fk_orphans(e, d, "department_id", "department_id"), "employee_id")]
    assert orphans == [4]


def test_repeated_department_name(spark):
    d = _depts(spark, [(1, "Sales", "a"), (10, "Sales", "b")])
    e = _emps(spark, [(1, 1, Decimal("10.00")), (2, 10, Decimal("20.00"))])
    assert rows(A.department_stats(d, e), "department_name", "employee_count", "avg_salary") == [("Sales", 2, 15.0)]
    assert len(A.department_headcount(d, e).collect()) == 2


def test_null_amount(spark):
    data = [(1, 7, "a", SEED_AS_OF, None, "P"), (2, 7, "a", SEED_AS_OF, Decimal("4.00"), "P"),
            (3, 8, "a", SEED_AS_OF, None, "P")]
    got = rows(A.customer_sales(_orders(spark, data), SEED_AS_OF, 30))
    assert got[0] == (8, 1, None, None)          # all-NULL group sorts first under DESC
    assert got[1] == (7, 2, Decimal("4.00"), 4.0)  # COUNT(*) counts the NULL, SUM/AVG skip it


def test_key_lists(spark, seed):
    d = seed["order_details"]
    got = rows(lookups.details_by_orders(d, [1, 1, 3]), "order_id", "detail_id")
    assert got == [(1, 1), (1, 2), (3, 5), (3, 6), (3, 7)]
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "order_id bigint")
    assert rows(lookups.details_by_orders(d, keys), "order_id", "detail_id") == got
    assert lookups.details_by_orders(d, []).count() == 0
    assert [r[0] for r in rows(lookups.details_by_orders(d, [None, 1]), "order_id")] == [1, 1]
    many = list(range(3, 5000))
    assert rows(lookups.details_by_orders(d, many), "detail_id") == [(5,), (6,), (7,), (8,), (9,), (10,)]
    assert lookups.departments_by_ids(seed["departments"], [2, 2, 42]).count() == 1
    assert lookups.department_by_id(seed["departments"], 42).count() == 0


def test_having_edge(spark):
    from fetchplan.sources.tables import ORDER_DETAILS
    o = _orders(spark, [(1, 1, "a", SEED_AS_OF, Decimal("1.00"), "P")])
    d = spark.createDataFrame([(1, 1, 7, "p", 1, Decimal("1000.00")), (2, 1, 8, "p", 1, Decimal("1000.01"))],
                              ORDER_DETAILS)
    assert [r[0] for r in rows(A.product_revenue(d, o, SEED_AS_OF, 60, 1000), "product_id")] == [8]


@pytest.mark.parametrize("text,want", [("1234.50", "1234.5"), ("1000.00", "1000"), ("0.50", ".5"),
                                       ("0.00", "0"), ("-0.25", "-.25"), ("12", "12")])
def test_oracle_number_text(spark, text, want):
    df = spark.createDataFrame([(Decimal(text),)], "x decimal(12,2)")
    assert df.select(X.oracle_num(F.col("x")).alias("s")).first()["s"] == want


def test_oracle_concat_null(spark):
    df = spark.createDataFrame([(None,)], "x decimal(12,2)")
    assert df.select(F.concat(F.lit("$"), X.nz(X.oracle_num(F.col("x")))).alias("s")).first()["s"] == "$"


def test_cascade_delete(spark, seed):
    deleted = seed["orders"].filter(F.col("order_id").isin(1, 2))
    left = Q.cascade_delete(seed["order_details"], deleted, "order_id", "order_id")
    assert sorted(r[0] for r in rows(left, "detail_id")) == list(range(5, 11))


def test_quality_checks(spark):
    e = spark.createDataFrame([(1, "e1", Decimal("1.00")), (1, "e2", None), (None, "e3", None)],
                              "employee_id bigint, email string, salary decimal(10,2)")
    pk = rows(Q.pk_violations(e, "employees", ["employee_id"]), "key_value", "row_count")
    assert sorted(pk, key=str) == sorted([('{"employee_id":1}', 2), ('{"employee_id":null}', 1)], key=str)
    nulls = rows(Q.null_violations(e, "employees", ["employee_id", "salary", "email"]), "column_name", "null_count")
    assert sorted(nulls) == [("employee_id", 1), ("salary", 2)]
    dup = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "email string")
    assert rows(Q.unique_violations(dup, "t", ["email"]), "key_value", "row_count") == [('{"email":"a"}', 2)]
    lim = spark.createDataFrame([("x" * 21, Decimal("1.5")), ("ok", Decimal("123456789012.5"))],
                                "status string, total decimal(20,2)")
    got = rows(Q.limit_violations(lim, "orders", {"status": 20}, {"total": (12, 2)}), "column_name", "violations")
    assert sorted(got) == [("status", 1), ("total", 1)]
    text = spark.createDataFrame([("99999999.99",), ("100000000",), ("1.005",), ("n/a",), (None,), ("-5",)], "price string")
    assert rows(Q.limit_violations(text, "t", None, {"price": (10, 2)}), "violations") == [(3,)]
    pairs = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a|b", "c"), ("a", "b|c"), (None, "NULL")], "x string, y string")
    keys = rows(Q.pk_violations(pairs, "t", ["x", "y"]), "key_value", "row_count")
    assert len(keys) == 3 and len({k for k, _ in keys}) == 3


def test_defaults_only_for_omitted_columns(spark):
    df = spark.createDataFrame([(1, None)], "order_id bigint, status string")
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    typed = Q.apply_defaults(df, Q.ORDER_DEFAULTS, now=now)
    assert dict(typed.dtypes)["total_amount"] == "decimal(12,2)" and dict(typed.dtypes)["order_date"] == "timestamp_ntz"
    assert Q.apply_defaults(df, {"customer_name": "now"}).first()["customer_name"] == "now"
    out = typed.first()
    assert out["status"] is None                   # explicit NULL stays NULL
    assert out["order_date"] == now and int(out["total_amount"]) == 0


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 59),)], "t timestamp_ntz")
    r = df.select(X.month_key("t").alias("m"), X.to_day(F.lit("2024-02-01")).alias("d"),
                  X.cutoff(dt.datetime(2024, 2, 20), 30).alias("c")).first()
    assert r["m"] == "2024-01" and r["d"] == dt.datetime(2024, 2, 1)
    assert r["c"] == dt.datetime(2024, 1, 21)
    labels = spark.createDataFrame([(0.0,), (90.0,), (35.25,), (12.34,)], "r double").select(
        X.pct_label(F.col("r")).alias("l"))
    assert [x["l"] for x in labels.collect()] == ["N/A", "90.0%", "35.2%", "12.3%"]


def test_cutoff_ignores_session_time_zone(spark):
    data = [(1, 1, "a", dt.datetime(2024, 5, 31, 0, 0, 0), None, None),
            (2, 1, "a", dt.datetime(2024, 5, 30, 23, 0, 0), None, None)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = [r[0] for r in rows(lookups.recent_orders(_orders(spark, data), SEED_AS_OF, 30), "order_id")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1]


def test_table_counts_reports_a_failing_table(spark, seed):
    def missing():
        return spark.read.parquet("/nonexistent/fetchplan/table.parquet")

    got = {r["table_name"]: (r["row_count"], r["status"]) for r in A.table_counts(
        {"orders": seed["orders"], "broken": missing, "order_details": lambda: seed["order_details"]}).collect()}
    assert got["orders"] == (6, "ok") and got["order_details"] == (10, "ok")
    assert got["broken"][0] is None and got["broken"][1].startswith("error")


def test_table_counts_reports_a_corrupt_file(spark, seed, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "bad"))
    for f in (tmp_path / "bad").glob("part-*.parquet"):
        f.write_bytes(f.read_bytes()[:40] + b"x" * 40)
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    schema = "id long"
    got = {r["table_name"]: (r["row_count"], r["status"]) for r in A.table_counts(
        {"bad": lambda: spark.read.schema(schema).parquet(str(tmp_path / "bad")), "orders": seed["orders"]}).collect()}
    assert got["orders"] == (6, "ok") and got["bad"][0] is None and got["bad"][1].startswith("error: ")
    alone = A.table_counts({"gone": lambda: spark.read.parquet(str(tmp_path / "gone"))}).collect()
    assert [(r["table_name"], r["row_count"]) for r in alone] == [("gone", None)]


def test_variants_agree_counts_multiset_differences(spark):
    from fetchplan.plans.variants import variants_agree
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    c = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    got = {(r["variant_a"], r["variant_b"]): (r["rows_a"], r["rows_b"], r["only_in_a"], r["only_in_b"], r["agree"])
           for r in variants_agree({"a": a, "b": b, "c": c}).collect()}
    assert got == {("a", "b"): (3, 2, 2, 1, False), ("a", "c"): (3, 3, 0, 0, True)}


def test_per_row_shape_rejects_duplicate_department_ids(spark):
    d = _depts(spark, [(1, "Sales", "a"), (1, "Sales again", "b")])
    e = _emps(spark, [(1, 1, Decimal("1.00"))])
    assert len(nesting.employees_departments_join(e, d).collect()) == 2   # join shape repeats the employee
    with pytest.raises(Exception):
        nesting.employees_departments_lateral(e, d).collect()            # scalar subquery: one row at most
