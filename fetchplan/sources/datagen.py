"""Test tables of any size with a chosen skew, as Spark jobs (S3).

Every value is a function of the row's id and the seed, so the rows do not
depend on partitioning or task retries.  ``hot_share`` gives that share of all
details to order 1, which lies a day before ``as_of``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.functions.scalar import ntz

EMPLOYEES_PER_DEPARTMENT = 25
LINES_PER_ORDER = 4
ORDER_DAYS = 400


def _pick(seed: int, salt: str, n: int) -> Column:
    """A whole number in [0, n) from the column ``id``."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id"), F.lit(n))


def _money(seed: int, salt: str, low: int, high: int, kind: str) -> Column:
    """Whole cents between two amounts."""
    return ((_pick(seed, salt, (high - low) * 100) + low * 100) / 100).cast(kind)


def generate(spark: SparkSession, as_of: _dt.datetime, seed: int = 42, n_departments: int = 20,
             n_orders: int = 1000, hot_share: float = 0.0) -> dict[str, DataFrame]:
    """The four tables: n departments, 25 employees each, n orders, 4 details each (and order 1's share)."""
    if not 0 <= hot_share < 1:
        raise ValueError("hot_share must be in [0, 1)")
    departments = spark.range(1, n_departments + 1).select(
        F.col("id").alias("department_id"), F.format_string("unit %d", F.pmod("id", F.lit(11))).alias("department_name"),
        F.when(_pick(seed, "place", 5) > 0, F.format_string("site %d", _pick(seed, "place", 5))).alias("location"))
    employees = spark.range(1, n_departments * EMPLOYEES_PER_DEPARTMENT + 1).select(
        F.col("id").alias("employee_id"), F.format_string("f%d", "id").alias("first_name"),
        F.format_string("l%d", _pick(seed, "name", 500)).alias("last_name"),
        F.format_string("e%d@example.com", "id").alias("email"),
        (F.pmod("id", F.lit(n_departments)) + 1).alias("department_id"),
        _money(seed, "salary", 1000, 9000, "decimal(10,2)").alias("salary"),
        (ntz(as_of) - F.make_dt_interval(_pick(seed, "hired", 5000).cast("int"))).alias("hire_date"))
    age = F.when(F.col("id") == 1, F.lit(1)).otherwise(_pick(seed, "day", ORDER_DAYS).cast("int"))
    customer = _pick(seed, "customer", max(1, n_orders // 5)) + 1
    orders = spark.range(1, n_orders + 1).select(
        F.col("id").alias("order_id"), customer.alias("customer_id"),
        F.format_string("customer %d", customer).alias("customer_name"),
        (ntz(as_of) - F.make_dt_interval(age)).alias("order_date"),
        _money(seed, "total", 5, 5000, "decimal(12,2)").alias("total_amount"),
        F.element_at(F.array(F.lit("OPEN"), F.lit("SENT"), F.lit("DONE")), (_pick(seed, "status", 3) + 1).cast("int"))
        .alias("status"))
    plain = n_orders * LINES_PER_ORDER
    hot = round(plain * hot_share / (1 - hot_share))
    product = _pick(seed, "product", 1000) + 1
    order_of = F.when(F.col("id") <= plain, F.floor((F.col("id") - 1) / LINES_PER_ORDER) + 1).otherwise(F.lit(1))
    details = spark.range(1, plain + hot + 1).select(
        F.col("id").alias("detail_id"), order_of.cast("bigint").alias("order_id"), product.alias("product_id"),
        F.format_string("product %d", product).alias("product_name"),
        (_pick(seed, "quantity", 9) + 1).cast("int").alias("quantity"),
        _money(seed, "price", 1, 300, "decimal(10,2)").alias("unit_price"))
    return {"departments": departments, "employees": employees, "orders": orders, "order_details": details}
