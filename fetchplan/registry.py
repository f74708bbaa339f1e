"""Registered queries: Spark job + DuckDB oracle SQL per key.

Every query reads the driver tables of ``sf_dir`` through the stand-in views
and runs the library operator over the whole tables.  Oracle SQL computes the
same result independently in DuckDB; columns are aliased identically.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.functions import lookup_functions as LF
from fetchplan.functions.scalar import department_label, look_back
from fetchplan.operators import aggregates as A
from fetchplan.operators import daily as D
from fetchplan.operators import limits as L
from fetchplan.operators import heavy, lookups, nesting
from fetchplan.operators import measure as M
from fetchplan.operators import quality as Q
from fetchplan.plans import variants as PV
from fetchplan.session import checkpoint_dir
from fetchplan.sources import sinks as SK
from fetchplan.sources import tables as _tables
from fetchplan.sources import views as V
from fetchplan.sources.views import AS_OF, AS_OF_SQL, DETAIL_ORDER, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def cutoff_sql(days: int) -> str:
    return f"({AS_OF_SQL} - INTERVAL {int(days)} DAY)"


_DETAIL_SORT_SQL = "d.line_number, d.product_id, d.supplier_id, d.quantity, d.unit_price"

_NESTED_ORACLE = with_views("ord", "det") + f"""
SELECT p.order_id, p.customer_id, p.order_date, p.total_amount, count(d.order_id) AS detail_count,
       CAST(coalesce(sum(CAST(d.quantity AS DECIMAL(8,0)) * d.unit_price), 0) AS DECIMAL(38,2)) AS detail_amount,
       CAST(coalesce(sum(d.quantity), 0) AS BIGINT) AS quantity_sum,
       CAST(coalesce(sum(d.product_id * d.quantity), 0) AS BIGINT) AS product_quantity_sum
FROM (SELECT * FROM ord WHERE order_date >= {cutoff_sql(30)}) p LEFT JOIN det d ON p.order_id = d.order_id
GROUP BY p.order_id, p.customer_id, p.order_date, p.total_amount
"""


def _nested(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = V.driver(spark, sf_dir)
        nested = fn(V.orders(d), V.order_details(d), AS_OF, 30, DETAIL_ORDER)
        return nesting.flatten_nested(nested)
    return run


register("orders_nested_batch", _NESTED_ORACLE)(_nested(nesting.orders_nested_batch))
register("orders_nested_join", _NESTED_ORACLE)(_nested(nesting.orders_nested_join))
register("orders_nested_lateral", _NESTED_ORACLE)(_nested(nesting.orders_nested_lateral))


@register("details_in_page_order", with_views("ord", "det") + f"""
SELECT o.order_id, row_number() OVER (PARTITION BY o.order_id ORDER BY {_DETAIL_SORT_SQL}) AS place,
       d.line_number, d.product_id, d.supplier_id, d.quantity, d.unit_price
FROM ord o JOIN det d ON o.order_id = d.order_id WHERE o.order_date >= {cutoff_sql(30)}""")
def q_details_in_page_order(spark, sf_dir):
    """J3 with pages of about two details: a detail's place when an order's pages are read one after another."""
    d = V.driver(spark, sf_dir)
    paged = nesting.orders_nested_batch(V.orders(d), V.order_details(d), AS_OF, 30, DETAIL_ORDER, ordered=False, max_children=2)
    return nesting.places_in_pages(paged).select("order_id", "place", *[f"detail.{c}" for c in DETAIL_ORDER])


@register("heavy_products", with_views("det") + """
SELECT product_id, count(*) AS row_count FROM det GROUP BY product_id HAVING count(*) > 40""")
def q_heavy_products(spark, sf_dir):
    """Products on more than 40 detail lines, by frequent-key summaries and an exact count."""
    return heavy.heavy_keys(V.order_details(V.driver(spark, sf_dir)), "product_id", above=40)


# ------------------------------------------------------------------ helpers

def _d(spark, sf_dir):
    return V.driver(spark, sf_dir)


# ------------------------------------------------------- scans and lookups



@register("employees_scan", with_views("emp") + """
SELECT employee_id, first_name, last_name, email, department_id, salary, hire_date FROM emp""")
def q_employees_scan(spark, sf_dir):
    return _tables.employees_scan(V.employees(_d(spark, sf_dir)))


@register("recent_orders", with_views("ord") + f"""
SELECT order_id, customer_id, order_date, total_amount FROM ord WHERE order_date >= {cutoff_sql(30)}""")
def q_recent_orders(spark, sf_dir):
    return lookups.recent_orders(V.orders(_d(spark, sf_dir)), AS_OF, 30)


@register("recent_orders_slim", with_views("ord") + f"""
SELECT order_id, customer_id, total_amount FROM ord WHERE order_date >= {cutoff_sql(7)}""")
def q_recent_orders_slim(spark, sf_dir):
    return lookups.recent_orders_slim(V.orders(_d(spark, sf_dir)), AS_OF, 7)


# Point lookups: the lookup key is the operator's argument.
POINT_ORDER_ID = 7
POINT_DEPARTMENT_ID = 3


@register("details_by_order", with_views("det") + f"""
SELECT order_id, line_number, product_id, supplier_id, quantity, unit_price FROM det
WHERE order_id = {POINT_ORDER_ID}""")
def q_details_by_order(spark, sf_dir):
    return lookups.details_by_order(V.order_details(_d(spark, sf_dir)), POINT_ORDER_ID, DETAIL_ORDER)


@register("department_by_id", with_views("dept") + f"""
SELECT department_id, department_name, location FROM dept WHERE department_id = {POINT_DEPARTMENT_ID}""")
def q_department_by_id(spark, sf_dir):
    return lookups.department_by_id(V.departments(_d(spark, sf_dir)), POINT_DEPARTMENT_ID)


@register("details_by_orders", with_views("ord", "det") + f"""
SELECT order_id, line_number, product_id, supplier_id, quantity, unit_price FROM det
WHERE order_id IN (SELECT order_id FROM ord WHERE order_date >= {cutoff_sql(30)})""")
def q_details_by_orders(spark, sf_dir):
    d = _d(spark, sf_dir)
    keys = V.orders(d).filter(look_back("order_date", AS_OF, 30))
    return lookups.details_by_orders(V.order_details(d), keys.select("order_id"), DETAIL_ORDER)


@register("departments_by_ids", with_views("dept", "emp") + """
SELECT department_id, department_name, location FROM dept
WHERE department_id IN (SELECT department_id FROM emp)""")
def q_departments_by_ids(spark, sf_dir):
    d = _d(spark, sf_dir)
    return lookups.departments_by_ids(V.departments(d), V.employees(d).select("department_id"))


@register("employees_in_departments", with_views("emp") + """
SELECT employee_id, first_name, last_name FROM emp WHERE department_id IN (1, 2, 23)""")
def q_employees_in_departments(spark, sf_dir):
    return lookups.employees_in_departments(V.employees(_d(spark, sf_dir)), (1, 2, 23))


@register("line_amounts", with_views("det") + """
SELECT order_id, line_number, product_id, supplier_id, quantity, unit_price,
       CAST(CAST(quantity AS DECIMAL(8,0)) * unit_price AS DECIMAL(19,2)) AS line_amount FROM det""")
def q_line_amounts(spark, sf_dir):
    return lookups.with_line_amount(V.order_details(_d(spark, sf_dir)))


@register("distinct_department_ids", with_views("emp") + """
SELECT DISTINCT department_id FROM emp WHERE department_id IS NOT NULL""")
def q_distinct_department_ids(spark, sf_dir):
    return lookups.distinct_keys(V.employees(_d(spark, sf_dir)), "department_id")


# ------------------------------------------------------------------- joins

register("orders_details_flat", with_views("ord", "det") + f"""
SELECT p.order_id, p.customer_id, p.order_date, p.total_amount,
       d.line_number, d.product_id, d.supplier_id, d.quantity, d.unit_price
FROM (SELECT * FROM ord WHERE order_date >= {cutoff_sql(30)}) p LEFT JOIN det d ON p.order_id = d.order_id""")(
    lambda spark, sf_dir: nesting.orders_details_flat(
        V.orders(_d(spark, sf_dir)), V.order_details(_d(spark, sf_dir)), AS_OF, 30, DETAIL_ORDER))

_EMP_DEPT_ORACLE = with_views("emp", "dept") + """
SELECT e.employee_id, e.first_name, e.last_name, e.email, e.department_id, e.hire_date, e.salary,
       CASE WHEN d.department_name IS NOT NULL AND d.location IS NOT NULL THEN d.department_name END
         AS department_name,
       CASE WHEN d.department_name IS NOT NULL AND d.location IS NOT NULL THEN d.location END
         AS location
FROM emp e LEFT JOIN dept d ON e.department_id = d.department_id"""


def _emp_dept(fn):
    def run(spark, sf_dir):
        d = _d(spark, sf_dir)
        return nesting.flatten_employees(fn(V.employees(d), V.departments(d)))
    return run


register("employees_departments_join", _EMP_DEPT_ORACLE)(_emp_dept(nesting.employees_departments_join))
register("employees_departments_batch", _EMP_DEPT_ORACLE)(_emp_dept(nesting.employees_departments_batch))
register("employees_departments_lateral", _EMP_DEPT_ORACLE)(
    _emp_dept(nesting.employees_departments_lateral))


@register("employee_labels", with_views("emp", "dept") + """
SELECT e.employee_id,
       CASE WHEN d.department_name IS NOT NULL AND d.location IS NOT NULL
            THEN d.department_name || ' (' || d.location || ')' ELSE 'unknown' END AS department_label
FROM emp e LEFT JOIN dept d ON e.department_id = d.department_id""")
def q_employee_labels(spark, sf_dir):
    d = _d(spark, sf_dir)
    j = nesting.employees_departments_join(V.employees(d), V.departments(d))
    return j.select("employee_id", department_label(
        F.col("department.department_name"), F.col("department.location")).alias("department_label"))


_RECENT_LINE_COLS = ("order_id", "customer_id", "total_amount", "line_number", "product_id", "quantity")


@register("recent_lines_capped_count", with_views("ord", "det") + f"""
SELECT least(count(*), 100) AS row_count FROM det d JOIN ord o ON o.order_id = d.order_id
WHERE o.order_date >= {cutoff_sql(7)}""")
def q_recent_lines_capped_count(spark, sf_dir):
    d = _d(spark, sf_dir)
    capped = L.recent_lines_capped(V.orders(d), V.order_details(d), AS_OF, 7, 100, _RECENT_LINE_COLS)
    return capped.agg(F.count(F.lit(1)).alias("row_count"))


@register("recent_lines_capped", with_views("ord", "det") + f"""
, j AS (SELECT o.order_id, o.customer_id, o.total_amount, d.line_number, d.product_id, d.quantity
        FROM det d JOIN ord o ON o.order_id = d.order_id WHERE o.order_date >= {cutoff_sql(7)})
SELECT least(count(*), 1000) AS row_count, CAST(0 AS BIGINT) AS not_in_join FROM j""")
def q_recent_lines_capped(spark, sf_dir):
    """Which rows an unordered cap returns is open; how many, and that all are rows of the join, is not."""
    d = _d(spark, sf_dir)
    o, det = V.orders(d), V.order_details(d)
    capped = L.recent_lines_capped(o, det, AS_OF, 7, 1000, _RECENT_LINE_COLS)
    whole = L.recent_lines(o, det, AS_OF, 7, _RECENT_LINE_COLS)
    extra = PV.compare_pair(capped, whole)
    return extra.select(F.col("rows_a").alias("row_count"), F.col("only_in_a").alias("not_in_join"))


@register("fk_orphans", with_views("emp", "dept") + """
SELECT employee_id, department_id FROM emp e
WHERE department_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dept d WHERE d.department_id = e.department_id)""")
def q_fk_orphans(spark, sf_dir):
    d = _d(spark, sf_dir)
    return Q.fk_orphans(V.employees(d), V.departments(d), "department_id", "department_id").select(
        "employee_id", "department_id")


@register("cascade_delete", with_views("ord", "det") + """
SELECT order_id, line_number, product_id, supplier_id, quantity, unit_price FROM det d
WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.order_id = d.order_id AND o.status = 'F')""")
def q_cascade_delete(spark, sf_dir):
    d = _d(spark, sf_dir)
    deleted = V.orders(d).filter(F.col("status") == "F")
    return Q.cascade_delete(V.order_details(d), deleted, "order_id", "order_id")


# ------------------------------------------------------------- aggregates

_AVG_SQL = "round(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0), 4)"


@register("customer_sales", with_views("ord") + f"""
SELECT customer_id, count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_sales,
       {_AVG_SQL.format(x='total_amount')} AS avg_order_value
FROM ord WHERE order_date >= {cutoff_sql(30)} GROUP BY customer_id""")
def q_customer_sales(spark, sf_dir):
    return A.customer_sales(V.orders(_d(spark, sf_dir)), AS_OF, 30)


@register("customer_sales_totals", with_views("ord") + f"""
SELECT customer_id, count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_sales
FROM ord WHERE order_date >= {cutoff_sql(30)} GROUP BY customer_id""")
def q_customer_sales_totals(spark, sf_dir):
    return A.customer_sales(V.orders(_d(spark, sf_dir)), AS_OF, 30, with_avg=False)


@register("customer_order_counts", with_views("ord") + f"""
SELECT customer_id, count(*) AS order_count FROM ord WHERE order_date >= {cutoff_sql(30)} GROUP BY customer_id""")
def q_customer_order_counts(spark, sf_dir):
    return A.customer_order_counts(V.orders(_d(spark, sf_dir)), AS_OF, 30)


@register("monthly_sales", with_views("ord") + f"""
SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS monthly_orders,
       CAST(sum(total_amount) AS DECIMAL(22,2)) AS monthly_revenue, count(DISTINCT customer_id) AS unique_customers
FROM ord WHERE order_date >= {cutoff_sql(180)} GROUP BY 1""")
def q_monthly_sales(spark, sf_dir):
    return A.monthly_sales(V.orders(_d(spark, sf_dir)), AS_OF, 180)


def _kept_daily(spark, daily: DataFrame) -> DataFrame:
    """A daily table, written to the session's shared folder and read back."""
    path = f"{checkpoint_dir(spark)}/daily-{uuid.uuid4().hex}"
    D.write_daily(daily, path)
    return D.read_daily(spark, path)


@register("customer_sales_by_day", ORACLE["customer_sales"])
def q_customer_sales_by_day(spark, sf_dir):
    """A1 from sums per day; of the orders only the cutoff's day is read again."""
    orders = V.orders(_d(spark, sf_dir))
    return D.customer_sales(_kept_daily(spark, D.daily_sales(orders)), orders, AS_OF, 30)


@register("monthly_sales_by_day", ORACLE["monthly_sales"])
def q_monthly_sales_by_day(spark, sf_dir):
    orders = V.orders(_d(spark, sf_dir))
    return D.monthly_sales(_kept_daily(spark, D.daily_sales(orders)), orders, AS_OF, 180)


@register("recent_customers", with_views("ord") + f"""
SELECT count(DISTINCT customer_id) AS unique_customers FROM ord WHERE order_date >= {cutoff_sql(90)}""")
def q_recent_customers(spark, sf_dir):
    """Distinct customers of 90 days, from the sets of customers kept per day."""
    orders = V.orders(_d(spark, sf_dir))
    return D.unique_customers(_kept_daily(spark, D.daily_customers(orders)), orders, AS_OF, 90)


@register("department_stats", with_views("emp", "dept") + f"""
SELECT d.department_name, count(e.employee_id) AS employee_count,
       {_AVG_SQL.format(x='e.salary')} AS avg_salary,
       min(e.salary) AS min_salary, max(e.salary) AS max_salary
FROM dept d LEFT JOIN emp e ON d.department_id = e.department_id GROUP BY d.department_name""")
def q_department_stats(spark, sf_dir):
    d = _d(spark, sf_dir)
    return A.department_stats(V.departments(d), V.employees(d))


@register("department_headcount", with_views("emp", "dept") + """
SELECT d.department_id, d.department_name, count(e.employee_id) AS employee_count
FROM dept d LEFT JOIN emp e ON d.department_id = e.department_id
GROUP BY d.department_id, d.department_name""")
def q_department_headcount(spark, sf_dir):
    d = _d(spark, sf_dir)
    return A.department_headcount(V.departments(d), V.employees(d))


# The stand-in money is larger than the reference's, so the HAVING bound is
# raised to keep it selective.
PRODUCT_MIN_REVENUE = 1_000_000


@register("product_revenue", with_views("ord", "det") + f"""
SELECT d.product_id, CAST(sum(d.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(CAST(d.quantity AS DECIMAL(8,0)) * d.unit_price) AS DECIMAL(29,2)) AS total_revenue,
       count(DISTINCT o.customer_id) AS unique_buyers
FROM det d JOIN ord o ON d.order_id = o.order_id
WHERE o.order_date >= {cutoff_sql(60)}
GROUP BY d.product_id
HAVING sum(CAST(d.quantity AS DECIMAL(8,0)) * d.unit_price) > {PRODUCT_MIN_REVENUE}""")
def q_product_revenue(spark, sf_dir):
    d = _d(spark, sf_dir)
    return A.product_revenue(V.order_details(d), V.orders(d), AS_OF, 60, PRODUCT_MIN_REVENUE)


@register("order_totals", with_views("ordc", "det") + """
SELECT o.order_id, o.customer_name, o.order_date, count(d.order_id) AS detail_count,
       CAST(sum(CAST(d.quantity AS DECIMAL(8,0)) * d.unit_price) AS DECIMAL(29,2)) AS calculated_total
FROM ordc o LEFT JOIN det d ON o.order_id = d.order_id
GROUP BY o.order_id, o.customer_name, o.order_date""")
def q_order_totals(spark, sf_dir):
    d = _d(spark, sf_dir)
    return A.order_totals(V.orders(d, with_customer_name=True), V.order_details(d))


@register("recent_order_count", with_views("ord") + f"""
SELECT count(*) AS order_count FROM ord WHERE order_date >= {cutoff_sql(30)}""")
def q_recent_order_count(spark, sf_dir):
    return A.recent_order_count(V.orders(_d(spark, sf_dir)), AS_OF, 30)


@register("table_counts", with_views("ord", "det", "emp", "dept") + """
SELECT 'orders' AS table_name, count(*) AS row_count, 'ok' AS status FROM ord
UNION ALL SELECT 'order_details', count(*), 'ok' FROM det
UNION ALL SELECT 'employees', count(*), 'ok' FROM emp
UNION ALL SELECT 'departments', count(*), 'ok' FROM dept""")
def q_table_counts(spark, sf_dir):
    d = _d(spark, sf_dir)
    return A.table_counts({
        "orders": lambda: V.orders(d), "order_details": lambda: V.order_details(d),
        "employees": lambda: V.employees(d), "departments": lambda: V.departments(d)})


@register("object_summary", with_views("objects") + """
SELECT count(*) AS cached_objects, CAST(sum(blocks) AS BIGINT) AS total_blocks FROM objects WHERE type = 'signup'""")
def q_object_summary(spark, sf_dir):
    return A.object_summary(V.objects(_d(spark, sf_dir)), "signup")


# ----------------------------------------------------------------- limits

_PREVIEW_SQL = with_views("ord", "det") + f"""
, p AS (SELECT order_id, customer_id, order_date, total_amount FROM ord
        WHERE order_date >= {cutoff_sql(30)} ORDER BY order_id LIMIT 5)
, r AS (SELECT p.*, d.product_id, d.quantity,
               row_number() OVER (PARTITION BY p.order_id ORDER BY {_DETAIL_SORT_SQL}) AS rn,
               count(d.order_id) OVER (PARTITION BY p.order_id) AS n
        FROM p LEFT JOIN det d ON p.order_id = d.order_id)
SELECT order_id, customer_id, order_date, total_amount,
       coalesce(string_agg(CASE WHEN rn <= 3 AND product_id IS NOT NULL
                THEN CAST(product_id AS VARCHAR) || ':' || CAST(quantity AS VARCHAR) END, ',' ORDER BY rn), '')
         AS shown_details,
       greatest(max(n) - 3, 0) AS more_details
FROM r GROUP BY order_id, customer_id, order_date, total_amount"""


@register("order_preview", _PREVIEW_SQL)
def q_order_preview(spark, sf_dir):
    d = _d(spark, sf_dir)
    return L.order_preview(V.orders(d), V.order_details(d), AS_OF, 30, 5, 3, DETAIL_ORDER)


@register("employee_preview", with_views("emp", "dept") + """
SELECT e.employee_id, e.first_name, e.last_name, e.email, e.salary,
       CASE WHEN d.department_name IS NOT NULL AND d.location IS NOT NULL
            THEN d.department_name || ' (' || d.location || ')' ELSE 'unknown' END AS department_label
FROM (SELECT * FROM emp ORDER BY employee_id LIMIT 5) e LEFT JOIN dept d ON e.department_id = d.department_id""")
def q_employee_preview(spark, sf_dir):
    d = _d(spark, sf_dir)
    return L.employee_preview(V.employees(d), V.departments(d), 5)


# -------------------------------------------------------------- functions

_ORACLE_NUM_SQL = """regexp_replace(regexp_replace(
    CASE WHEN contains({s}, '.') THEN regexp_replace(regexp_replace({s}, '0+$', ''), '\\.$', '')
         ELSE {s} END, '^0\\.', '.'), '^-0\\.', '-.')"""


@register("customer_summary", with_views("ord") + f"""
, g AS (SELECT customer_id, count(*) AS n, sum(total_amount) AS total FROM ord
        WHERE order_date >= {cutoff_sql(90)} GROUP BY customer_id)
SELECT c.c_custkey AS customer_id,
       'Orders: ' || CAST(coalesce(g.n, 0) AS VARCHAR) || ', Total: $' ||
       coalesce({_ORACLE_NUM_SQL.format(s='CAST(round(g.total, 2) AS VARCHAR)')}, '') AS summary
FROM customer c LEFT JOIN g ON c.c_custkey = g.customer_id""")
def q_customer_summary(spark, sf_dir):
    d = _d(spark, sf_dir)
    return LF.customer_order_summary(d.customer.select(F.col("c_custkey").alias("customer_id")),
                                     V.orders(d), AS_OF, 90)


@register("department_name_lookup", with_views("emp", "dept") + """
SELECT e.employee_id, e.department_id, d.department_name
FROM emp e LEFT JOIN dept d ON e.department_id = d.department_id""")
def q_department_name_lookup(spark, sf_dir):
    d = _d(spark, sf_dir)
    return LF.department_name_lookup(V.employees(d).select("employee_id", "department_id"),
                                     V.departments(d))


# ---------------------------------------------------------------- quality

_RAW = {t: f"raw_{t}" for t in _tables.SCHEMAS}
_RAW_VIEWS = with_views(*_RAW.values())


def _json_sql(cols: list[str]) -> str:
    return "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in cols) + "}) AS VARCHAR)"


def _over_tables(check: Callable[[DataFrame, str], DataFrame]):
    """The union of a check over the four raw business tables."""
    def run(spark, sf_dir):
        raw = V.raw_tables(_d(spark, sf_dir))
        out = None
        for name in _tables.SCHEMAS:
            part = check(raw[name], name)
            out = part if out is None else out.unionByName(part)
        return out
    return run


register("pk_violations", _RAW_VIEWS + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {_json_sql(k)} AS key_value, count(*) AS row_count FROM {_RAW[t]} "
    f"GROUP BY {', '.join(k)} HAVING count(*) > 1 OR {' OR '.join(f'{c} IS NULL' for c in k)}"
    for t, k in _tables.PRIMARY_KEYS.items()))(
    _over_tables(lambda df, t: Q.pk_violations(df, t, _tables.PRIMARY_KEYS[t])))


@register("unique_violations", _RAW_VIEWS + f"""
SELECT 'employees' AS table_name, 'email' AS column_name, {_json_sql(['email'])} AS key_value, count(*) AS row_count
FROM raw_employees WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1""")
def q_unique_violations(spark, sf_dir):
    raw = V.raw_tables(_d(spark, sf_dir))
    out = None
    for t, keys in _tables.UNIQUE_KEYS.items():
        for k in keys:
            part = Q.unique_violations(raw[t], t, k)
            out = part if out is None else out.unionByName(part)
    return out


register("null_violations", _RAW_VIEWS + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {_RAW[t]}"
    for t, cols in _tables.NOT_NULL.items() for c in cols) + "\n) WHERE null_count > 0")(
    _over_tables(lambda df, t: Q.null_violations(df, t, _tables.NOT_NULL[t])))


def _limits_sql() -> str:
    parts = []
    for t in _tables.SCHEMAS:
        for c, n in _tables.VARCHAR_LIMITS[t].items():
            parts.append((t, c, f"length>{n}", f"length({c}) > {n}"))
        for c, (p, s) in _tables.NUMBER_LIMITS[t].items():
            x = f"TRY_CAST({c} AS DECIMAL(38,10))"
            parts.append((t, c, f"number({p},{s})", f"{c} IS NOT NULL AND ({x} IS NULL OR abs({x}) >= {10 ** (p - s)} "
                                                    f"OR {x} <> round({x}, {s}))"))
    return _RAW_VIEWS + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{rule}' AS rule, count(*) FILTER (WHERE {bad}) AS violations "
        f"FROM {_RAW[t]}" for t, c, rule, bad in parts) + "\n) WHERE violations > 0"


register("limit_violations", _limits_sql())(_over_tables(
    lambda df, t: Q.limit_violations(df, t, _tables.VARCHAR_LIMITS[t], _tables.NUMBER_LIMITS[t])))


# ----------------------------------------------------------- measurements


_R4 = "round({x}, 4)"
_DIV = "CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


@register("speedup_vs_baseline", with_views("runs") + f"""
, r AS (SELECT *, first_value(exec_ns) OVER (PARTITION BY suite ORDER BY seq) AS base_ns,
               row_number() OVER (PARTITION BY suite ORDER BY seq) AS rn FROM runs)
SELECT suite, seq, method, exec_ns, base_ns, (rn = 1) AS is_baseline,
       CASE WHEN rn > 1 THEN round({_DIV.format(a='base_ns', b='exec_ns')}, 4) END AS speedup
FROM r""")
def q_speedup_vs_baseline(spark, sf_dir):
    return M.speedup_vs_baseline(V.runs(_d(spark, sf_dir)))


_RANKED_RUNS = with_views("runs") + """
, r AS (SELECT *, first_value(exec_ns) OVER (PARTITION BY suite ORDER BY seq) AS base_ns,
               row_number() OVER (PARTITION BY suite ORDER BY seq) AS rn FROM runs)"""


@register("best_method", _RANKED_RUNS + f"""
, c AS (SELECT *, row_number() OVER (PARTITION BY suite ORDER BY exec_ns, seq) AS pick FROM r WHERE rn > 1)
SELECT suite, method AS best_method, seq AS best_seq, exec_ns AS best_ns, base_ns,
       round({_DIV.format(a='base_ns', b='exec_ns')}, 4) AS improvement
FROM c WHERE pick = 1""")
def q_best_method(spark, sf_dir):
    return M.best_method(V.runs(_d(spark, sf_dir)))


@register("time_saved", _RANKED_RUNS + """
, t AS (SELECT suite, max(CASE WHEN rn = 1 THEN exec_ns END) AS base_ns,
               max(CASE WHEN rn = 2 THEN exec_ns END) AS opt_ns FROM r GROUP BY suite)
SELECT suite, base_ns, opt_ns, base_ns - opt_ns AS saved_ns,
       round(CAST(base_ns - opt_ns AS DOUBLE) / CAST(base_ns AS DOUBLE) * 100, 4) AS saved_pct
FROM t WHERE opt_ns IS NOT NULL AND base_ns > opt_ns""")
def q_time_saved(spark, sf_dir):
    return M.time_saved(V.runs(_d(spark, sf_dir)))


@register("mean_run_time", with_views("runs") + """
SELECT suite, count(*) AS runs, CAST(sum(exec_ns) AS BIGINT) AS total_ns,
       CAST(sum(exec_ns) // count(*) AS BIGINT) AS mean_ns FROM runs GROUP BY suite""")
def q_mean_run_time(spark, sf_dir):
    return M.mean_run_time(V.runs(_d(spark, sf_dir)), ("suite",))


@register("warm_hit_rate", with_views("run_log") + """
, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY run_no) AS rn FROM run_log)
SELECT grp, count(*) AS runs, count(*) FILTER (WHERE rn > 1 AND exec_ms < 50) AS warm_hits,
       round(CAST(count(*) FILTER (WHERE rn > 1 AND exec_ms < 50) AS DOUBLE)
             / nullif(CAST(count(*) - 1 AS DOUBLE), 0) * 100, 4) AS warm_hit_rate
FROM r GROUP BY grp""")
def q_warm_hit_rate(spark, sf_dir):
    return M.warm_hit_rate(V.run_log(_d(spark, sf_dir)))


@register("hit_rate", with_views("run_log") + """
SELECT grp, count(*) AS runs, count(*) FILTER (WHERE hit) AS hits,
       round(CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 4) AS hit_rate
FROM run_log GROUP BY grp""")
def q_hit_rate(spark, sf_dir):
    return M.hit_rate(V.run_log(_d(spark, sf_dir)))


_DELTA_COLS = M._DELTAS


def _half_up(c: str) -> str:
    return f"CAST(round(CAST({c} AS DECIMAL(38,12)), 4) AS DOUBLE)"


def _round_sql(cte: str, columns: dict[str, bool], table: str) -> str:
    """Final SELECT of a CTE: doubles (True) rounded to 4 places, half up as decimals."""
    return cte + "\nSELECT " + ", ".join(f"{_half_up(c)} AS {c}" if r else c for c, r in columns.items()) + f" FROM {table}"


_DELTA_CTE = with_views("counter_snapshots") + f"""
, s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY snapshot_no) AS rn_i,
               row_number() OVER (PARTITION BY source ORDER BY snapshot_no DESC) AS rn_f,
               count(*) OVER (PARTITION BY source) AS snapshots FROM counter_snapshots)
, i AS (SELECT * FROM s WHERE rn_i = 1)
, f AS (SELECT * FROM s WHERE rn_f = 1)
, delta AS (
  SELECT f.source, f.snapshots, {', '.join(f'f.{c} - i.{c} AS d_{c}' for c in _DELTA_COLS)},
         f.total_bytes AS total_bytes,
         CASE WHEN f.logical_reads - i.logical_reads > 0
              THEN CAST((f.logical_reads - i.logical_reads - f.physical_reads + i.physical_reads) * 100 AS DOUBLE)
                   / CAST(f.logical_reads - i.logical_reads AS DOUBLE)
              ELSE f.buffer_hit_ratio END AS buffer_hit_ratio,
         f.result_hit_ratio AS result_hit_ratio,
         CASE WHEN f.created - i.created > 0 THEN (f.objects - i.objects) * 2 ELSE 0 END AS cache_hits,
         CASE WHEN f.created - i.created > 0 THEN f.created - i.created ELSE 0 END AS cache_misses
  FROM f JOIN i ON f.source = i.source)"""
_DELTA_OUT = {"source": False, "snapshots": False, **{f"d_{c}": False for c in _DELTA_COLS}, "total_bytes": False,
              "buffer_hit_ratio": True, "result_hit_ratio": True, "cache_hits": False, "cache_misses": False}

_EFF_CTE = _DELTA_CTE + """
, e0 AS (SELECT *, CASE WHEN d_logical_reads > 0
                     THEN CAST((d_logical_reads - d_physical_reads) * 100 AS DOUBLE) / CAST(d_logical_reads AS DOUBLE)
                     ELSE 0.0 END AS b,
                CAST(result_hit_ratio AS DOUBLE) AS r,
                CAST(total_bytes + d_memory_bytes AS DOUBLE) AS mem FROM delta)
, e1 AS (SELECT *, CAST(b AS DECIMAL(28,12)) * CAST(0.7 AS DECIMAL(2,1)) + CAST(r AS DECIMAL(28,12)) * CAST(0.3 AS DECIMAL(2,1)) AS score FROM e0)
, eff AS (
  SELECT source, b AS buffer_efficiency, r AS result_efficiency, CAST(score AS DOUBLE) AS overall_efficiency,
         CASE WHEN mem > 0 THEN CAST(score AS DOUBLE) / (mem / 1073741824.0) ELSE 0.0 END AS memory_efficiency_ratio,
         CASE WHEN d_logical_reads > 0
              THEN CAST(d_physical_reads * 100 AS DOUBLE) / CAST(d_logical_reads AS DOUBLE)
              ELSE 0.0 END AS physical_read_pct,
         mem / 1048576.0 AS total_cache_mb, CAST(total_bytes AS DOUBLE) / 1048576.0 AS buffer_cache_mb,
         CAST(d_memory_bytes AS DOUBLE) / 1048576.0 AS result_cache_mb,
         d_logical_reads - d_physical_reads AS io_saved, CAST(score * CAST(0.1 AS DECIMAL(2,1)) AS DOUBLE) AS cpu_savings,
         CASE WHEN cache_hits + cache_misses > 0
              THEN CAST(cache_hits * 100 AS DOUBLE) / CAST(cache_hits + cache_misses AS DOUBLE) END AS result_hit_share
  FROM e1)"""
_EFF_OUT = {"source": False, "buffer_efficiency": True, "result_efficiency": True, "overall_efficiency": True,
            "memory_efficiency_ratio": True, "physical_read_pct": True, "total_cache_mb": True, "buffer_cache_mb": True,
            "result_cache_mb": True, "io_saved": False, "cpu_savings": True, "result_hit_share": True}


def _delta(spark, sf_dir):
    return M.counter_delta(V.counter_snapshots(_d(spark, sf_dir)))


@register("counter_delta", _round_sql(_DELTA_CTE, _DELTA_OUT, "delta"))
def q_counter_delta(spark, sf_dir):
    return M.rounded(_delta(spark, sf_dir))


@register("cache_efficiency", _round_sql(_EFF_CTE, _EFF_OUT, "eff"))
def q_cache_efficiency(spark, sf_dir):
    return M.rounded(M.cache_efficiency(_delta(spark, sf_dir)))


_TIER_SQL = ("CASE WHEN overall_efficiency >= 90 THEN 'maintain' WHEN overall_efficiency >= 70 THEN 'improve' "
             "ELSE 'urgent' END")


@register("efficiency_tier", _EFF_CTE + f"""
SELECT source, {_half_up('overall_efficiency')} AS overall_efficiency, {_TIER_SQL} AS tier FROM eff""")
def q_efficiency_tier(spark, sf_dir):
    return M.rounded(M.efficiency_tier(M.cache_efficiency(_delta(spark, sf_dir))))


_RULES_SQL = ", ".join(f"({n}, {rank}, '{action}', '{category}', {effort})" for n, rank, _, _, action, category, effort in M.RULES)
_RECS_CTE = f"""
, rules AS (SELECT * FROM (VALUES {_RULES_SQL}) t(rule_no, rank, action, category, effort))
, recs AS (SELECT d.source, r.rule_no, r.rank, r.action, r.category, r.effort FROM delta d JOIN rules r
  ON (r.rule_no = 1 AND d.buffer_hit_ratio < 90) OR (r.rule_no = 2 AND d.result_hit_ratio < 70)
  OR r.rule_no IN (3, 4))"""


@register("recommendations", _DELTA_CTE + _RECS_CTE + "\nSELECT * FROM recs")
def q_recommendations(spark, sf_dir):
    delta = _delta(spark, sf_dir)
    return M.recommendations(M.cache_efficiency(delta), delta)


def _hints_sql():
    vals = ",\n    ".join(f"('{c}', {n}, '{m}', '{a}')" for c, n, m, _, _, a in M.HINTS)
    return _DELTA_CTE + f"""
, hints AS (SELECT * FROM (VALUES
    {vals}) t(cache, hint_no, metric, action))
SELECT d.source, h.cache, h.hint_no, h.metric, h.action FROM delta d JOIN hints h ON
     (h.cache = 'buffer' AND h.hint_no = 1 AND d.buffer_hit_ratio < 90)
  OR (h.cache = 'buffer' AND h.hint_no = 2 AND d.d_free_waits > 100)
  OR (h.cache = 'buffer' AND h.hint_no = 3 AND d.d_busy_waits > 100)
  OR (h.cache = 'buffer' AND h.hint_no = 4 AND d.buffer_hit_ratio >= 95)
  OR (h.cache = 'result' AND h.hint_no = 1 AND d.result_hit_ratio < 50)
  OR (h.cache = 'result' AND h.hint_no = 2 AND d.d_invalidated > CAST(trunc(d.d_created / 2) AS BIGINT))
  OR (h.cache = 'result' AND h.hint_no = 3 AND d.d_memory_bytes > 104857600)
  OR (h.cache = 'result' AND h.hint_no = 4 AND d.result_hit_ratio >= 80)"""


@register("threshold_hints", _hints_sql())
def q_threshold_hints(spark, sf_dir):
    return M.threshold_hints(_delta(spark, sf_dir))


_MEANS_CTE = with_views("cache_results") + """
, means AS (SELECT grp, method, CAST(sum(exec_ns) // count(*) AS BIGINT) AS exec_ns,
                   CAST(sum(memory_bytes) // count(*) AS BIGINT) AS memory_bytes,
                   round(avg(hit_rate), 4) AS hit_rate, min(seq) AS seq
            FROM cache_results GROUP BY grp, method)"""


def _means(spark, sf_dir):
    return M.cache_means(V.cache_results(_d(spark, sf_dir)))


@register("cache_comparison", _MEANS_CTE + """
SELECT grp, method, exec_ns, hit_rate,
       CASE WHEN hit_rate = 0 THEN 'N/A' ELSE printf('%.1f%%', hit_rate) END AS hit_label FROM means""")
def q_cache_comparison(spark, sf_dir):
    return M.comparison_table(_means(spark, sf_dir))


@register("integrated_results", _MEANS_CTE.replace("WITH ", _EFF_CTE + ",\n", 1).replace(
    "WITH cache_results", "cache_results") + """
SELECT grp, method, exec_ns, memory_bytes, hit_rate FROM means
UNION ALL
SELECT m.grp, 'integrated', CAST(sum(m.exec_ns) // count(*) AS BIGINT), CAST(sum(m.memory_bytes) AS BIGINT),
       CAST(round(CAST(max(e.overall_efficiency) AS DECIMAL(38,12)), 4) AS DOUBLE)
FROM means m LEFT JOIN eff e ON m.grp = e.source GROUP BY m.grp""")
def q_integrated_results(spark, sf_dir):
    return M.rounded(M.integrated_results(_means(spark, sf_dir), M.cache_efficiency(_delta(spark, sf_dir))))


@register("fastest_family", _MEANS_CTE + """
, fam AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY exec_ns, seq) AS pick FROM means
          WHERE starts_with(method, 'c') OR starts_with(method, 'p'))
, rival AS (SELECT grp, exec_ns AS rival_ns FROM means WHERE method = 'view')
SELECT f.grp, f.method AS fastest_method, f.exec_ns AS fastest_ns, r.rival_ns,
       CASE WHEN f.exec_ns < r.rival_ns THEN round(CAST(r.rival_ns AS DOUBLE) / CAST(f.exec_ns AS DOUBLE), 4) END
         AS speedup
FROM fam f JOIN rival r ON f.grp = r.grp WHERE f.pick = 1""")
def q_fastest_family(spark, sf_dir):
    return M.fastest_family(_means(spark, sf_dir), ("c", "p"), "view")


@register("hit_ratio", with_views("name_values") + """
, g AS (SELECT source, CAST(sum(CASE WHEN name = 'error' THEN value END) AS BIGINT) AS phy,
               CAST(sum(CASE WHEN name = 'view' THEN value END) AS BIGINT) AS cur,
               CAST(sum(CASE WHEN name = 'click' THEN value END) AS BIGINT) AS con
        FROM name_values GROUP BY source)
SELECT source, phy, cur, con,
       round((1.0 - CAST(phy AS DOUBLE) / nullif(CAST(cur + con AS DOUBLE), 0)) * 100, 2) AS buffer_hit_ratio
FROM g""")
def q_hit_ratio(spark, sf_dir):
    return M.hit_ratio(V.name_values(_d(spark, sf_dir)), "error", "view", "click")


@register("top_waits", with_views("waits") + """
SELECT event_id, event, total_waits, total_timeouts, time_waited_micro,
       round(CAST(time_waited_micro AS DOUBLE) / nullif(CAST(total_waits AS DOUBLE), 0) / 1000, 4) AS avg_wait_ms
FROM waits WHERE event LIKE '%ur%' OR event LIKE '%i%' AND total_waits > 0
ORDER BY time_waited_micro DESC, event, event_id LIMIT 5""")
def q_top_waits(spark, sf_dir):
    return M.top_waits(V.waits(_d(spark, sf_dir)), 5, "ur", "i", ("event_id",))


@register("size_advice", with_views("size_estimates") + """
SELECT event_id, size_factor, read_factor,
       CASE WHEN read_factor > 1.1 THEN 'undersized'
            WHEN read_factor < 0.9 AND size_factor > 1.0 THEN 'oversized' ELSE 'fit' END AS advice
FROM size_estimates WHERE name = 'view' AND status = 'READY'""")
def q_size_advice(spark, sf_dir):
    return M.size_advice(V.size_estimates(_d(spark, sf_dir)), "view", "READY")


@register("component_sizes", with_views("components") + """
SELECT component, CAST(sum(bytes) AS BIGINT) AS bytes, round(CAST(sum(bytes) AS DOUBLE) / 1048576.0, 4) AS size_mb
FROM components WHERE component IN ('click', 'view', 'purchase') GROUP BY component""")
def q_component_sizes(spark, sf_dir):
    return M.component_sizes(V.components(_d(spark, sf_dir)), ("click", "view", "purchase"))


# ------------------------------------------------ agreement, generator, JSON



_AGREE_CHILDREN = "order_id, customer_id, order_date, total_amount, line_number, product_id, supplier_id, quantity, unit_price"


def _pair_sql(a: str, b: str, va: str, vb: str) -> str:
    """One pair's row computed from two independently written queries."""
    return (f"SELECT '{a}' AS variant_a, '{b}' AS variant_b, (SELECT count(*) FROM {va}) AS rows_a, "
            f"(SELECT count(*) FROM {vb}) AS rows_b, "
            f"(SELECT count(*) FROM (SELECT * FROM {va} EXCEPT ALL SELECT * FROM {vb})) AS only_in_a, "
            f"(SELECT count(*) FROM (SELECT * FROM {vb} EXCEPT ALL SELECT * FROM {va})) AS only_in_b")


_AGREE_SQL = with_views("ord", "det", "emp", "dept") + f"""
, v_join AS (SELECT {_AGREE_CHILDREN.replace('order_id', 'o.order_id', 1)} FROM ord o LEFT JOIN det d ON o.order_id = d.order_id
             WHERE o.order_date >= {cutoff_sql(30)})
, p AS (SELECT order_id, customer_id, order_date, total_amount FROM ord WHERE order_date >= {cutoff_sql(30)})
, k AS (SELECT * FROM det WHERE order_id IN (SELECT order_id FROM p))
, v_batch AS (SELECT {_AGREE_CHILDREN.replace('order_id', 'p.order_id', 1)} FROM p JOIN k ON p.order_id = k.order_id
              UNION ALL SELECT order_id, customer_id, order_date, total_amount, NULL, NULL, NULL, NULL, NULL FROM p
              WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.order_id = p.order_id))
, v_lateral AS (SELECT {_AGREE_CHILDREN.replace('order_id', 'p.order_id', 1)} FROM p LEFT JOIN LATERAL
                (SELECT line_number, product_id, supplier_id, quantity, unit_price FROM det d WHERE d.order_id = p.order_id) ON true)
, v_week AS (SELECT * FROM v_join WHERE order_date >= {cutoff_sql(7)})
, v_emp_join AS (SELECT e.*, CASE WHEN d.location IS NOT NULL THEN d.department_name END AS n,
                        CASE WHEN d.department_name IS NOT NULL THEN d.location END AS l
                 FROM emp e LEFT JOIN dept d ON e.department_id = d.department_id)
, v_emp_lateral AS (SELECT e.*, (SELECT CASE WHEN d.location IS NOT NULL THEN d.department_name END FROM dept d
                                 WHERE d.department_id = e.department_id) AS n,
                           (SELECT CASE WHEN d.department_name IS NOT NULL THEN d.location END FROM dept d
                            WHERE d.department_id = e.department_id) AS l FROM emp e)
, v_emp_batch AS (SELECT e.*, CASE WHEN f.location IS NOT NULL THEN f.department_name END AS n,
                         CASE WHEN f.department_name IS NOT NULL THEN f.location END AS l
                  FROM emp e LEFT JOIN (SELECT * FROM dept WHERE department_id IN (SELECT department_id FROM emp)) f
                  ON e.department_id = f.department_id)
SELECT *, rows_a = rows_b AND only_in_a = 0 AND only_in_b = 0 AS agree FROM (
{_pair_sql('batch', 'join', 'v_batch', 'v_join')}
UNION ALL {_pair_sql('batch', 'lateral', 'v_batch', 'v_lateral')}
UNION ALL {_pair_sql('batch', 'week', 'v_batch', 'v_week')}
UNION ALL {_pair_sql('emp_join', 'emp_batch', 'v_emp_join', 'v_emp_batch')}
UNION ALL {_pair_sql('emp_join', 'emp_lateral', 'v_emp_join', 'v_emp_lateral')})"""


@register("variants_agree", _AGREE_SQL)
def q_variants_agree(spark, sf_dir):
    """The shapes pairwise, and a pair that must differ (30 days against 7)."""
    d = _d(spark, sf_dir)
    o, det, e, dp = V.orders(d), V.order_details(d), V.employees(d), V.departments(d)

    def rows(shape, days=30):
        return nesting.child_rows(shape(o, det, AS_OF, days, DETAIL_ORDER, ordered=False))

    frames = {
        "batch": rows(nesting.orders_nested_batch),
        "join": rows(nesting.orders_nested_join),
        "lateral": rows(nesting.orders_nested_lateral),
        "week": rows(nesting.orders_nested_batch, 7),
        "emp_join": nesting.flatten_employees(nesting.employees_departments_join(e, dp, ordered=False)),
        "emp_batch": nesting.flatten_employees(nesting.employees_departments_batch(e, dp, ordered=False)),
        "emp_lateral": nesting.flatten_employees(nesting.employees_departments_lateral(e, dp, ordered=False)),
    }
    return PV.variants_agree(frames, [("batch", "join"), ("batch", "lateral"), ("batch", "week"),
                                      ("emp_join", "emp_batch"), ("emp_join", "emp_lateral")])


@register("orders_json", with_views("ord", "det") + f"""
SELECT {_AGREE_CHILDREN.replace('order_id', 'o.order_id', 1)} FROM ord o LEFT JOIN det d ON o.order_id = d.order_id
WHERE o.order_date >= {cutoff_sql(30)}""")
def q_orders_json(spark, sf_dir):
    """Nested recent orders written as JSON documents, read back and unnested."""
    d = _d(spark, sf_dir)
    nested = nesting.orders_nested_batch(V.orders(d), V.order_details(d), AS_OF, 30, DETAIL_ORDER, ordered=False)
    return nesting.child_rows(SK.from_json_rows(SK.to_json_rows(nested), nested.schema))


@register("buffer_pool_sizes", with_views("pools") + """
SELECT name, block_size, round(CAST(current_bytes AS DOUBLE) / 1048576.0, 4) AS size_mb FROM pools""")
def q_buffer_pool_sizes(spark, sf_dir):
    """M14, pool form: one row per pool."""
    return M.pool_sizes(V.pools(_d(spark, sf_dir)))


@register("analysis_report_json", _EFF_CTE + _RECS_CTE + f"""
SELECT d.source, d.snapshots, d.d_blocks, {_half_up('d.buffer_hit_ratio')} AS buffer_hit_ratio,
       {_half_up('e.overall_efficiency')} AS overall_efficiency, {_TIER_SQL} AS tier,
       (SELECT string_agg(CAST(r.rule_no AS VARCHAR) || ':' || r.action || ':' || CAST(r.effort AS VARCHAR), ','
                          ORDER BY r.rank DESC, r.rule_no) FROM recs r WHERE r.source = d.source) AS recommendations
FROM delta d JOIN eff e ON d.source = e.source""")
def q_analysis_report_json(spark, sf_dir):
    """The per-source analysis report exported as JSON documents, and read back."""
    report = M.analysis_report(_delta(spark, sf_dir))
    back = SK.from_json_rows(SK.to_json_rows(report), report.schema)
    recs = F.transform("recommendations", lambda r: F.concat_ws(
        ":", r["rule_no"].cast("string"), r["action"], r["effort"].cast("string")))
    return back.select("source", "metrics.snapshots", "metrics.d_blocks", "metrics.buffer_hit_ratio",
                       "efficiency.overall_efficiency", "tier", F.array_join(recs, ",").alias("recommendations"))
