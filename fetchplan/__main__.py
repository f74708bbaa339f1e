"""Command line: compare the plan shapes on parquet tables.

    python -m fetchplan orders    --path DIR [--as-of 'YYYY-MM-DD HH:MM:SS'] [--days 30]
    python -m fetchplan employees --path DIR

``DIR`` holds ``orders.parquet``, ``order_details.parquet``,
``employees.parquet`` and ``departments.parquet`` in the business schemas.
Prints the runs table, the speed-ups, the best shape and whether the shapes
agree.
"""

from __future__ import annotations

import argparse
import datetime as dt

from fetchplan.plans import compare
from fetchplan.session import get_spark
from fetchplan.sources.tables import load_tables


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="fetchplan")
    p.add_argument("mode", choices=["orders", "employees"])
    p.add_argument("--path", required=True)
    p.add_argument("--as-of", default=None)
    p.add_argument("--days", type=int, default=30)
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = get_spark(a.master)
    t = load_tables(spark, {"format": "parquet", "path": a.path})
    if a.mode == "orders":
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now().replace(microsecond=0)
        out = compare.compare_order_shapes(spark, t["orders"], t["order_details"], as_of, a.days)
    else:
        out = compare.compare_employee_shapes(spark, t["employees"], t["departments"])
    for name in ("runs", "speedup", "best", "saved", "agree"):
        print(f"-- {name}")
        out[name].show(truncate=False)


if __name__ == "__main__":
    main()
