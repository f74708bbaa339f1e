"""Grouped and global aggregates (A1-A11) with Oracle ordering rules (L4).

Sums stay exact DECIMAL.  Means are ``round(double(sum) / count, 4)`` so the
value is the same whatever engine checks it; an all-NULL group gives NULL.
Oracle sorts NULLs first under DESC and last under ASC, the opposite of Spark,
so every ordering states its null placement and a key tie-break.

Fact-side work is aggregated before any join to a dimension (A5, A6, A8): the
partial aggregate combines rows map-side, so a hot key costs one partial row
per task, not a hot shuffle partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.functions.scalar import look_back, month_key
from fetchplan.operators import distinct_sets


def mean4(total: Column, count: Column) -> Column:
    """Mean as double rounded to 4 places; NULL for an empty group."""
    return F.round(F.try_divide(total.cast("double"), count.cast("double")), 4)


def _recent(orders: DataFrame, as_of, days: int) -> DataFrame:
    return orders.filter(look_back("order_date", as_of, days))


def customer_sales(orders: DataFrame, as_of, days: int = 30, with_avg: bool = True,
                   ordered: bool = True) -> DataFrame:
    """A1 (with_avg) / A2: orders, sum and mean per customer, by sum DESC."""
    aggs = [F.count(F.lit(1)).alias("order_count"),
            F.sum("total_amount").alias("total_sales")]
    if with_avg:
        aggs.append(mean4(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"))
    out = _recent(orders, as_of, days).groupBy("customer_id").agg(*aggs)
    if ordered:
        out = out.orderBy(F.col("total_sales").desc_nulls_first(), F.col("customer_id").asc())
    return out


def customer_order_counts(orders: DataFrame, as_of, days: int = 30) -> DataFrame:
    """A3: order count per customer in the look-back."""
    return _recent(orders, as_of, days).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"))


def monthly_sales(orders: DataFrame, as_of, days: int = 180, ordered: bool = True) -> DataFrame:
    """A4: per calendar month: orders, revenue, distinct customers.

    Customers are whole numbers: 64 neighbours share a row of the month's set,
    so what is shuffled is far less than the (month, customer) pairs.
    """
    recent = _recent(orders, as_of, days)
    per = recent.groupBy(month_key("order_date").alias("order_month"), distinct_sets.word("customer_id").alias("word")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"), distinct_sets.bits("customer_id").alias("bits"))
    kind = dict(per.dtypes)["revenue"]
    out = per.groupBy("order_month").agg(
        F.sum("orders").alias("monthly_orders"), F.sum("revenue").cast(kind).alias("monthly_revenue"),
        distinct_sets.members().alias("unique_customers"))
    return out.orderBy("order_month") if ordered else out


def _salary_by_department(employees: DataFrame) -> DataFrame:
    """Partial statistics per department id (employees with a department)."""
    return (employees.filter(F.col("department_id").isNotNull())
            .groupBy("department_id")
            .agg(F.count("employee_id").alias("_n"),
                 F.sum("salary").alias("_sum"),
                 F.count("salary").alias("_nsal"),
                 F.min("salary").alias("_min"),
                 F.max("salary").alias("_max")))


def department_stats(departments: DataFrame, employees: DataFrame,
                     ordered: bool = True) -> DataFrame:
    """A5: departments LEFT JOIN employees GROUP BY department_name only.

    Departments that share a name are merged; an empty department counts 0
    with NULL statistics and sorts first under ``avg_salary DESC``.
    """
    stats = _salary_by_department(employees)
    d = departments.select("department_id", "department_name")
    j = d.join(stats, "department_id", "left")
    out = j.groupBy("department_name").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("employee_count"),
        mean4(F.sum("_sum"), F.sum("_nsal")).alias("avg_salary"),
        F.min("_min").alias("min_salary"),
        F.max("_max").alias("max_salary"))
    if ordered:
        out = out.orderBy(F.col("avg_salary").desc_nulls_first(), F.col("department_name").asc())
    return out


def department_headcount(departments: DataFrame, employees: DataFrame,
                         ordered: bool = True) -> DataFrame:
    """Head-count GROUP BY (department_id, department_name), by id."""
    stats = _salary_by_department(employees).select("department_id", "_n")
    d = departments.select("department_id", "department_name")
    out = d.join(stats, "department_id", "left").select(
        "department_id", "department_name",
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("employee_count"))
    return out.orderBy("department_id") if ordered else out


def product_revenue(details: DataFrame, orders: DataFrame, as_of, days: int = 60,
                    min_revenue=1000, ordered: bool = True) -> DataFrame:
    """Per product over recent orders; HAVING revenue > ``min_revenue``."""
    recent = _recent(orders, as_of, days).select("order_id", "customer_id")
    lines = details.select("order_id", "product_id", "quantity", "unit_price").join(
        recent, "order_id", "inner")
    out = (lines.groupBy("product_id")
           .agg(F.sum("quantity").cast("bigint").alias("total_quantity"),
                F.sum(F.col("quantity").cast("decimal(8,0)") * F.col("unit_price")).alias("total_revenue"),
                F.countDistinct("customer_id").alias("unique_buyers"))
           .filter(F.col("total_revenue") > F.lit(min_revenue)))
    if ordered:
        out = out.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc())
    return out


def order_totals(orders: DataFrame, details: DataFrame, ordered: bool = True) -> DataFrame:
    """Per order, detail count and computed sum of line amounts.

    Details are aggregated per order first (order_id is the parent key), then
    joined to every order; a childless order has count 0 and a NULL sum.
    """
    per = details.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("quantity").cast("decimal(8,0)") * F.col("unit_price")).alias("calculated_total"))
    out = orders.select("order_id", "customer_name", "order_date").join(per, "order_id", "left").select(
        "order_id", "customer_name", "order_date",
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("detail_count"),
        "calculated_total")
    return out.orderBy("order_id") if ordered else out


def recent_order_count(orders: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Global COUNT(*) of the look-back; one row even when nothing matches."""
    return _recent(orders, as_of, days).agg(F.count(F.lit(1)).alias("order_count"))


def table_counts(tables: dict, names: Iterable[str] | None = None) -> DataFrame:
    """Row count per table; a failing table is reported and the others still count.

    ``tables`` maps a name to a DataFrame or to a zero-argument callable that
    builds it.  Each count is a job of its own (one number reaches the driver),
    so that a missing or unreadable table gives a NULL count and its error
    class, whatever the others do.
    """
    rows = []
    for name in list(names or tables):
        src = tables[name]
        try:
            rows.append((name, (src() if callable(src) else src).count(), "ok"))
        except Exception as ex:  # reported in the row, as the operator promises
            rows.append((name, None, f"error: {type(ex).__name__}"))
    return SparkSession.active().createDataFrame(rows, "table_name string, row_count bigint, status string")


def object_summary(objects: DataFrame, object_type: str = "Result") -> DataFrame:
    """COUNT(*) and SUM(blocks) over objects of one type; always one row."""
    return (objects.filter(F.col("type") == F.lit(object_type))
            .agg(F.count(F.lit(1)).alias("cached_objects"),
                 F.sum("blocks").alias("total_blocks")))
