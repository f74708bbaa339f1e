"""Stored lookup functions, set-based.

The reference calls a PL/SQL function once per id.  Here the ids are a
DataFrame and the function body is a grouped aggregate joined to it, so the
whole id list is answered by one job.  ``register_sql_functions`` also exposes
both as SQL scalar functions over session views for ad-hoc SQL; Catalyst
decorrelates their subqueries into joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.functions.scalar import look_back, nz, oracle_num


def summary_text(count_col, total_col):
    """``'Orders: ' || n || ', Total: $' || ROUND(sum, 2)`` with Oracle text rules."""
    return F.concat(F.lit("Orders: "), nz(count_col), F.lit(", Total: $"),
                    nz(oracle_num(F.round(total_col, 2))))


def customer_order_summary(customer_ids: DataFrame, orders: DataFrame, as_of,
                           days: int = 90, key: str = "customer_id") -> DataFrame:
    """C1 for every id of ``customer_ids``.

    An aggregate without GROUP BY always yields a row, so an id without orders
    reads ``Orders: 0, Total: $`` (the NO_DATA_FOUND branch never fires).
    """
    per = (orders.filter(look_back("order_date", as_of, days))
           .groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_total")))
    ids = customer_ids.select(F.col(key).alias("customer_id"))
    j = ids.join(per, "customer_id", "left")
    return j.select("customer_id", summary_text(
        F.coalesce(F.col("_n"), F.lit(0)), F.col("_total")).alias("summary"))


def department_name_lookup(rows: DataFrame, departments: DataFrame,
                           key: str = "department_id") -> DataFrame:
    """Attach ``department_name`` for each row's department id (NULL if none)."""
    d = departments.select(F.col("department_id").alias("_dk"), "department_name")
    return rows.join(d, F.col(key) == F.col("_dk"), "left").drop("_dk")


# Oracle number text in SQL (same rule as ``oracle_num``).
_ORACLE_NUM_SQL = (r"regexp_replace(regexp_replace(CASE WHEN contains({s}, '.') THEN "
                   r"regexp_replace(regexp_replace({s}, '0+$', ''), '\\.$', '') ELSE {s} END, "
                   r"'^0\\.', '.'), '^-0\\.', '-.')")


def register_sql_functions(spark: SparkSession, orders_view: str = "orders",
                           departments_view: str = "departments", as_of: str | None = None,
                           days: int = 90) -> None:
    """Create session SQL functions ``department_name(id)``,
    ``customer_order_count(id)``, ``customer_order_total(id)`` and
    ``customer_order_summary(id)`` (C1 text) over the named temp views."""
    ref = f"TIMESTAMP_NTZ '{as_of}'" if as_of else "localtimestamp()"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION department_name(p_dept_id BIGINT)
        RETURNS STRING
        RETURN (SELECT max(department_name) FROM {departments_view}
                WHERE department_id = p_dept_id)""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_order_count(p_customer_id BIGINT)
        RETURNS BIGINT
        RETURN (SELECT count(*) FROM {orders_view}
                WHERE customer_id = p_customer_id
                  AND order_date >= {ref} - make_dt_interval({int(days)}))""")
    window = f"customer_id = p_customer_id AND order_date >= {ref} - make_dt_interval({int(days)})"
    text = _ORACLE_NUM_SQL.format(s="CAST(round(sum(total_amount), 2) AS STRING)")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_order_summary(p_customer_id BIGINT)
        RETURNS STRING
        RETURN (SELECT concat('Orders: ', count(*), ', Total: $', coalesce({text}, ''))
                FROM {orders_view} WHERE {window})""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_order_total(p_customer_id BIGINT)
        RETURNS DECIMAL(38,2)
        RETURN (SELECT sum(total_amount) FROM {orders_view}
                WHERE customer_id = p_customer_id
                  AND order_date >= {ref} - make_dt_interval({int(days)}))""")
