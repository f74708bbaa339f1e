"""Filters, point and key-list lookups, projections.

Look-back filters take ``as_of`` as an argument; the cutoff is a literal so the
predicate reaches the parquet scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.functions.scalar import look_back
from fetchplan.plans.strategy import key_filtered

ORDER_COLS = ("order_id", "customer_id", "order_date", "total_amount")
# Business schema: details sort by detail_id.  Stand-in views without a unique
# detail id pass the whole line tuple instead (sort keys first).
DETAIL_COLS = ("detail_id", "product_id", "quantity", "unit_price")


def recent_orders(orders: DataFrame, as_of, days: int = 30,
                  cols: Iterable[str] = ORDER_COLS) -> DataFrame:
    """F1 ``GetOrdersByDays``: ``order_date >= as_of - days``, by order_id."""
    return orders.filter(look_back("order_date", as_of, days)).select(*cols).orderBy("order_id")


def recent_orders_slim(orders: DataFrame, as_of, days: int = 7) -> DataFrame:
    """three columns of the last ``days`` days, by order_id."""
    return recent_orders(orders, as_of, days, ("order_id", "customer_id", "total_amount"))


def details_by_order(details: DataFrame, order_id: int,
                     detail_cols: Iterable[str] = DETAIL_COLS) -> DataFrame:
    """children of one parent, in detail order."""
    cols = list(detail_cols)
    return (details.filter(F.col("order_id") == F.lit(order_id))
            .select("order_id", *[c for c in cols if c != "order_id"])
            .orderBy(*cols))


def department_by_id(departments: DataFrame, department_id) -> DataFrame:
    """zero or one department; a missing id is an empty frame, not an error."""
    return (departments.filter(F.col("department_id") == F.lit(department_id))
            .select("department_id", "department_name", "location"))


# A longer Python key list becomes a DataFrame of keys instead of an IN list.
MAX_IN_LIST = 1000


def _key_filter(df: DataFrame, key: str, keys) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys``.

    ``keys`` may be a Python list (short: an IN list; empty: no rows; long: a
    frame of keys) or a DataFrame with a ``key`` column.  A frame's keys are made
    distinct and semi-joined, so repeated keys never multiply rows; Catalyst or
    adaptive execution broadcasts them by their size in bytes.  NULL keys match nothing.
    """
    if isinstance(keys, DataFrame):
        return key_filtered(df, keys.select(key), key).join(distinct_keys(keys, key), key, "left_semi")
    vals = sorted({v for v in keys if v is not None})
    if not vals:
        return df.limit(0)
    if len(vals) > MAX_IN_LIST:
        kind = df.schema[key].dataType.simpleString()
        return df.join(df.sparkSession.createDataFrame([(v,) for v in vals], f"{key} {kind}"), key, "left_semi")
    return df.filter(F.col(key).isin(vals))


def details_by_orders(details: DataFrame, order_ids,
                      detail_cols: Iterable[str] = DETAIL_COLS) -> DataFrame:
    """F4 ``GetDetailsByOrderIDs``: children of a key list, by order_id then detail."""
    cols = [c for c in detail_cols if c != "order_id"]
    return (_key_filter(details, "order_id", order_ids)
            .select("order_id", *cols).orderBy("order_id", *cols))


def departments_by_ids(departments: DataFrame, department_ids) -> DataFrame:
    """F5 ``GetDepartmentsByIDs``: departments of a key list (no ordering)."""
    return (_key_filter(departments, "department_id", department_ids)
            .select("department_id", "department_name", "location"))


def employees_in_departments(employees: DataFrame, department_ids=(10, 20, 30)) -> DataFrame:
    """static IN list over department_id, three columns."""
    return (employees.filter(F.col("department_id").isin(list(department_ids)))
            .select("employee_id", "first_name", "last_name"))


def with_line_amount(details: DataFrame) -> DataFrame:
    """Generated column ``line_amount = quantity * unit_price`` (exact decimal)."""
    return details.withColumn(
        "line_amount", F.col("quantity").cast("decimal(8,0)") * F.col("unit_price"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL key set of a column."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct()
