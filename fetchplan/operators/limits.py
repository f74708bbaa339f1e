"""Row caps, ordered top-k and nested previews.

Only ``limit`` after an ``orderBy`` is deterministic (TakeOrderedAndProject);
an unordered cap (``ROWNUM <= n``) returns some n rows, so only its count is
checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fetchplan.functions.scalar import department_label, look_back
from fetchplan.operators import nesting
from fetchplan.operators.lookups import DETAIL_COLS, ORDER_COLS


RECENT_LINE_COLS = ("order_id", "customer_id", "total_amount", "detail_id", "product_id", "quantity")


def recent_lines(orders: DataFrame, details: DataFrame, as_of, days: int = 7,
                 cols=RECENT_LINE_COLS) -> DataFrame:
    """Inner join of recent orders and their details (J8 without the cap); only ``cols`` are read."""
    own = [c for c in orders.columns if c in cols and c != "order_id"]
    recent = orders.filter(look_back("order_date", as_of, days)).select("order_id", *own)
    return details.join(recent, "order_id", "inner").select(*cols)


def recent_lines_capped(orders: DataFrame, details: DataFrame, as_of, days: int = 7,
                        cap: int = 1000, cols=RECENT_LINE_COLS) -> DataFrame:
    """Any ``cap`` rows of the recent inner join (no ordering)."""
    return recent_lines(orders, details, as_of, days, cols).limit(cap)


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """L3: ``ORDER BY ... FETCH FIRST k ROWS ONLY``."""
    return df.orderBy(*order).limit(k)


def order_preview(orders: DataFrame, details: DataFrame, as_of, days: int = 30,
                  n: int = 5, per_order: int = 3, detail_cols=DETAIL_COLS,
                  key_fields=("product_id", "quantity")) -> DataFrame:
    """First ``n`` recent orders by order_id, first ``per_order`` details each,
    and how many more details were not shown.

    The order cap is taken before any child work; the first children come
    from ``row_number() <= per_order`` (planned as a per-task top-k before the
    shuffle) and the remainder from a count, so no parent's children are ever
    collected whole.
    """
    dc = [c for c in detail_cols if c != "order_id"]
    parents = (orders.filter(look_back("order_date", as_of, days))
               .select(*ORDER_COLS).orderBy("order_id").limit(n))
    kids = details.select("order_id", *dc).join(parents.select("order_id"), "order_id", "left_semi")
    counts = kids.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    first = (kids.withColumn("_rn", F.row_number().over(Window.partitionBy("order_id").orderBy(*dc)))
             .filter(F.col("_rn") <= per_order))
    shown = first.groupBy("order_id").agg(F.array_sort(F.collect_list(
        F.struct(*[F.col(c) for c in dc]))).alias("_shown"))
    j = parents.join(shown, "order_id", "left").join(counts, "order_id", "left")
    text = F.array_join(F.transform(F.coalesce(F.col("_shown"), F.array()), lambda x: F.concat_ws(
        ":", *[x[f].cast("string") for f in key_fields])), ",")
    return j.select(
        *ORDER_COLS, text.alias("shown_details"),
        F.greatest(F.coalesce(F.col("_n"), F.lit(0)) - per_order, F.lit(0)).alias("more_details"),
    ).orderBy("order_id")


def employee_preview(employees: DataFrame, departments: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` employees by id with their department label."""
    first = employees.orderBy("employee_id").limit(n)
    j = nesting.employees_departments_join(first, departments, ordered=False)
    return j.select("employee_id", "first_name", "last_name", "email", "salary",
                    department_label(F.col("department.department_name"),
                                     F.col("department.location")).alias("department_label")
                    ).orderBy("employee_id")
