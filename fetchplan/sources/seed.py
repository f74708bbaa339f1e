"""Seed rows (S4): a small hand-made data set with the edges the operators care about.

A department without employees, one without a location, two that share a name;
an employee without a department and one without a salary; an order without
details, one on the 30-day cutoff of ``SEED_AS_OF`` and one a second before it.
Ids come from per-table sequences starting at 1.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.sources.tables import DEPARTMENTS, EMPLOYEES, ORDER_DETAILS, ORDERS

SEED_AS_OF = _dt.datetime(2024, 6, 30)

SEED_DEPARTMENTS = (("Binding", "North"), ("Print", "North"), ("Shipping", "South"), ("Archive", None),
                    ("Print", "South"), ("Garden", "East"))
# department_id, salary, hire date
SEED_EMPLOYEES = ((1, "3100.50", "2015-05-02"), (1, "2900.50", "2018-11-20"), (2, "4100.00", "2012-01-09"),
                  (5, "3900.00", "2019-07-15"), (4, "2500.00", "2021-03-01"), (3, None, "2022-08-22"),
                  (None, "2700.00", "2023-02-13"))
# customer_id, order date, total amount, status
SEED_ORDERS = ((71, "2024-03-31 08:00:00", "42.00", "DONE"), (72, "2024-05-31 00:00:00", "18.50", "DONE"),
               (71, "2024-06-03 12:30:00", "99.90", "OPEN"), (73, "2024-06-20 00:00:00", "7.25", "OPEN"),
               (72, "2024-06-29 23:59:59", "60.00", "SENT"), (74, "2024-05-30 23:59:59", "5.00", "SENT"))
# order_id, product_id, quantity, unit_price
SEED_DETAILS = ((1, 501, 2, "10.00"), (1, 502, 1, "22.00"), (2, 501, 1, "10.50"), (2, 503, 4, "2.00"),
                (3, 504, 3, "33.30"), (3, 501, 1, "10.00"), (3, 502, 2, "1.25"), (5, 505, 5, "12.00"),
                (5, 501, 2, "9.75"), (6, 503, 1, "5.00"))


def _money(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The four seed tables as DataFrames with the declared schemas."""
    at = _dt.datetime.fromisoformat
    depts = [(i, name, place) for i, (name, place) in enumerate(SEED_DEPARTMENTS, 1)]
    emps = [(i, f"f{i}", f"l{i}", f"e{i}@example.com", dept, _money(pay), at(hired))
            for i, (dept, pay, hired) in enumerate(SEED_EMPLOYEES, 1)]
    orders = [(i, c, f"customer {c}", at(day), _money(total), status)
              for i, (c, day, total, status) in enumerate(SEED_ORDERS, 1)]
    details = [(i, o, p, f"product {p}", q, _money(price)) for i, (o, p, q, price) in enumerate(SEED_DETAILS, 1)]
    return {
        "departments": spark.createDataFrame(depts, DEPARTMENTS),
        "employees": spark.createDataFrame(emps, EMPLOYEES),
        "orders": spark.createDataFrame(orders, ORDERS),
        "order_details": spark.createDataFrame(details, ORDER_DETAILS),
    }


def append_with_ids(existing: DataFrame, new_rows: DataFrame, id_col: str) -> DataFrame:
    """Insert rows with ids continuing the sequence after ``existing``'s maximum.

    ``new_rows`` must carry a dense 0-based ``_pos`` column (its position in
    the insert).  The maximum is an uncorrelated scalar subquery, evaluated
    once by Spark and used as a constant: no join, no driver round-trip and no
    per-row numbering across partitions.
    """
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    out = new_rows.withColumn(
        id_col, (top + F.col("_pos") + 1).cast(existing.schema[id_col].dataType))
    return existing.unionByName(out.select(*existing.columns))
