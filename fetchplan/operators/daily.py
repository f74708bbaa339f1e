"""Look-back aggregates from sums kept per day.

``daily_sales`` and ``daily_customers`` reduce orders to one row per day and
customer, and to the day's set of customers; ``write_daily`` keeps such a table
in a folder a month and rewrites only the months it is given.  A look-back is then
the whole days after the cutoff's day, from the table, plus the rest of
the cutoff's day, which is the only part of the orders that is read: their scan has both bounds of
that day.  Days after ``through``, which the table does not hold yet, are read
from the orders, too.  Every result equals that of the operator over all orders,
for any ``as_of``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.functions.scalar import cutoff, ntz
from fetchplan.operators import distinct_sets
from fetchplan.operators.aggregates import mean4

DAY, MONTH = "order_day", "order_month"
#: Files a month is written in, at most.
FILES = 8


def _day() -> Column:
    return F.to_date("order_date").alias(DAY)


def daily_sales(orders: DataFrame) -> DataFrame:
    """Per day and customer: orders, the sum of their amounts, and how many have one.  Orders without a date are left out."""
    return orders.where(F.col("order_date").isNotNull()).groupBy(_day(), "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("sales"), F.count("total_amount").alias("with_amount"))


def daily_customers(orders: DataFrame) -> DataFrame:
    """Per day: the set of its customers (``distinct_sets``)."""
    return distinct_sets.value_sets(orders.where(F.col("order_date").isNotNull()), [_day()], "customer_id")


def write_daily(daily: DataFrame, path: str) -> None:
    """Write a daily table, a folder a month; of one that is there, only the months in ``daily`` (whole ones) are replaced."""
    months = daily.withColumn(MONTH, F.date_format(DAY, "yyyy-MM"))
    # sorted by day, so that a scan skips the row groups of other days
    (months.repartition(MONTH, F.pmod(F.xxhash64(*daily.columns), F.lit(FILES))).sortWithinPartitions(MONTH, DAY)
     .write.partitionBy(MONTH).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("string"))


def _window(daily: DataFrame, orders: DataFrame, reduce, as_of, days: int, through: _dt.date | None) -> DataFrame:
    """Rows of ``daily`` for the whole days, and ``reduce`` of the orders of the days that are not: the cutoff's, and those after ``through``."""
    start = cutoff(as_of, days)
    edge = F.to_date(start)
    date = F.col("order_date")
    read = (date >= start) & (date < F.date_add(edge, 1).cast("timestamp_ntz"))
    whole = daily.where(F.col(DAY) > edge)
    if MONTH in daily.columns:  # a kept table: other months' folders are not listed
        whole = whole.where(F.col(MONTH) >= F.date_format(start, "yyyy-MM")).drop(MONTH)
    if through is not None:
        whole = whole.where(F.col(DAY) <= F.lit(through))
        later = date >= ntz(through + _dt.timedelta(days=1))
        read = read | (later & (date >= start))
    return whole.unionByName(reduce(orders.where(read)))


def customer_sales(daily: DataFrame, orders: DataFrame, as_of, days: int = 30, with_avg: bool = True, ordered: bool = True,
                   through: _dt.date | None = None) -> DataFrame:
    """A1 (with_avg) / A2 from ``daily_sales``: orders, sum and mean per customer, by sum DESC."""
    rows = _window(daily, orders, daily_sales, as_of, days, through)
    kind = dict(daily.dtypes)["sales"]
    total = F.sum("sales").cast(kind)
    aggs = [F.sum("orders").alias("order_count"), total.alias("total_sales")]
    if with_avg:
        aggs.append(mean4(total, F.sum("with_amount")).alias("avg_order_value"))
    out = rows.groupBy("customer_id").agg(*aggs)
    return out.orderBy(F.col("total_sales").desc_nulls_first(), F.col("customer_id").asc()) if ordered else out


def customer_order_counts(daily: DataFrame, orders: DataFrame, as_of, days: int = 30, through: _dt.date | None = None) -> DataFrame:
    """A3 from ``daily_sales``: order count per customer."""
    rows = _window(daily, orders, daily_sales, as_of, days, through)
    return rows.groupBy("customer_id").agg(F.sum("orders").alias("order_count"))


def recent_order_count(daily: DataFrame, orders: DataFrame, as_of, days: int = 30, through: _dt.date | None = None) -> DataFrame:
    """A9 from ``daily_sales``: one row even when nothing matches."""
    rows = _window(daily, orders, daily_sales, as_of, days, through)
    return rows.agg(F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("order_count"))


def monthly_sales(daily: DataFrame, orders: DataFrame, as_of, days: int = 180, ordered: bool = True, through: _dt.date | None = None) -> DataFrame:
    """A4 from ``daily_sales``: per calendar month orders, revenue and distinct customers."""
    rows = _window(daily, orders, daily_sales, as_of, days, through)
    kind = dict(daily.dtypes)["sales"]
    per = rows.groupBy(F.date_format(DAY, "yyyy-MM").alias("order_month"), distinct_sets.word("customer_id").alias("word")).agg(
        F.sum("orders").alias("orders"), F.sum("sales").alias("sales"), distinct_sets.bits("customer_id").alias("bits"))
    out = per.groupBy("order_month").agg(F.sum("orders").alias("monthly_orders"), F.sum("sales").cast(kind).alias("monthly_revenue"),
                                         distinct_sets.members().alias("unique_customers"))
    return out.orderBy("order_month") if ordered else out


def unique_customers(sets: DataFrame, orders: DataFrame, as_of, days: int = 30, through: _dt.date | None = None) -> DataFrame:
    """Distinct customers of a look-back, from ``daily_customers``: days are merged, not added."""
    rows = _window(sets, orders, daily_customers, as_of, days, through)
    return distinct_sets.merge_sets(rows, []).agg(distinct_sets.members().alias("unique_customers"))
