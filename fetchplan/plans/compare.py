"""Compare plan shapes end to end (the reference's main flow, E1/E2).

Each shape is run once to completion (``noop`` sink, nothing collected) and
timed; the timings become a small ``runs`` table (one row per shape) that is
scored with the same operators as any measurement table: speed-up against the
first shape (M1), best shape (M2), time saved by the second shape (M3).  The
shapes' contents are compared with ``variants_agree`` (M18).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fetchplan.operators import measure, nesting
from fetchplan.plans.variants import variants_agree

RUNS_SCHEMA = "suite string, seq int, method string, exec_ns bigint, record_count bigint"


def time_shapes(spark: SparkSession, suite: str, shapes: list[tuple[str, Callable[[], DataFrame]]],
                key: str) -> DataFrame:
    """Run each shape once and return ``runs(suite, seq, method, exec_ns, record_count)``.

    ``record_count`` counts distinct ``key`` values, so a parent on several pages is one record.
    Only the timing and the count of each shape reach the driver.
    """
    rows = []
    for seq, (method, build) in enumerate(shapes, start=1):
        t0 = time.perf_counter_ns()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter_ns() - t0
        rows.append((suite, seq, method, int(elapsed), df.select(key).distinct().count()))
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def score(runs: DataFrame) -> dict[str, DataFrame]:
    """Speed-ups, best shape and time saved for a ``runs`` table."""
    return {"speedup": measure.speedup_vs_baseline(runs), "best": measure.best_method(runs),
            "saved": measure.time_saved(runs)}


def compare_order_shapes(spark: SparkSession, orders: DataFrame, details: DataFrame, as_of,
                         days: int = 30, detail_cols=nesting.DETAIL_COLS) -> dict[str, DataFrame]:
    """Per-parent (lateral), join and batch shapes of the nested order fetch."""
    shapes = [
        ("per_parent", lambda: nesting.orders_nested_lateral(orders, details, as_of, days, detail_cols,
                                                             ordered=False)),
        ("join", lambda: nesting.orders_nested_join(orders, details, as_of, days, detail_cols, ordered=False)),
        ("batch", lambda: nesting.orders_nested_batch(orders, details, as_of, days, detail_cols, ordered=False)),
    ]
    runs = time_shapes(spark, "orders", shapes, "order_id")
    out = score(runs)
    out["runs"] = runs
    out["agree"] = variants_agree({name: nesting.child_rows(build()) for name, build in shapes})
    return out


def compare_employee_shapes(spark: SparkSession, employees: DataFrame,
                            departments: DataFrame) -> dict[str, DataFrame]:
    """Per-row (scalar subquery), join and batch shapes of employees with departments."""
    shapes = [
        ("per_row", lambda: nesting.employees_departments_lateral(employees, departments, ordered=False)),
        ("join", lambda: nesting.employees_departments_join(employees, departments, ordered=False)),
        ("batch", lambda: nesting.employees_departments_batch(employees, departments, ordered=False)),
    ]
    runs = time_shapes(spark, "employees", shapes, "employee_id")
    out = score(runs)
    out["runs"] = runs
    out["agree"] = variants_agree({name: build() for name, build in shapes})
    return out
