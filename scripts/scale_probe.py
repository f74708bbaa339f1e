"""Scale probe: the nested-fetch shapes on generated business tables.

Generates ``N`` orders (4 details each) with the library's own generator,
writes them as parquet to a fresh scratch folder, then times each shape
(median of 3 warm runs, ``noop`` sink) and records shuffle bytes from the
event log.  Prints one JSON line.

Usage: python scripts/scale_probe.py N [cpus] [departments]  (25 employees each)
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import _shuffle_bytes  # noqa: E402
from fetchplan.operators import aggregates as A  # noqa: E402
from fetchplan.operators import nesting  # noqa: E402
from fetchplan.session import get_spark  # noqa: E402
from fetchplan.sources import datagen  # noqa: E402

AS_OF = dt.datetime(2024, 2, 20)


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    work = tempfile.mkdtemp(prefix="fetchplan-scale-")
    logs = os.path.join(work, "eventlog")
    os.makedirs(logs)
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=64, app="fetchplan-scale", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs, "spark.eventLog.compress": "false",
        "spark.driver.memory": "16g"})
    n_depts = int(sys.argv[3]) if len(sys.argv) > 3 else 20
    g = datagen.generate(spark, AS_OF, seed=1, n_departments=n_depts, n_orders=n)
    for name in ("orders", "order_details", "employees", "departments"):
        g[name].write.mode("overwrite").parquet(os.path.join(work, name))
    o = spark.read.parquet(os.path.join(work, "orders"))
    d = spark.read.parquet(os.path.join(work, "order_details"))
    e = spark.read.parquet(os.path.join(work, "employees"))
    dp = spark.read.parquet(os.path.join(work, "departments"))
    rows = {"orders": o.count(), "order_details": d.count(), "employees": e.count()}
    shapes = {
        "nested_batch": lambda: nesting.orders_nested_batch(o, d, AS_OF, 30, ordered=False),
        "nested_join": lambda: nesting.orders_nested_join(o, d, AS_OF, 30, ordered=False),
        "nested_lateral": lambda: nesting.orders_nested_lateral(o, d, AS_OF, 30, ordered=False),
        "order_totals": lambda: A.order_totals(o, d, ordered=False),
        "employees_join": lambda: nesting.employees_departments_join(e, dp, ordered=False),
        "employees_batch": lambda: nesting.employees_departments_batch(e, dp, ordered=False),
        "employees_per_row": lambda: nesting.employees_departments_lateral(e, dp, ordered=False),
    }
    sc = spark.sparkContext
    out = {}
    for name, fn in shapes.items():
        sc.setJobGroup(f"warm:{name}", name)
        fn().write.format("noop").mode("overwrite").save()
        secs = []
        for i in range(3):
            sc.setJobGroup(f"run{i}:{name}", name)
            t0 = time.perf_counter()
            fn().write.format("noop").mode("overwrite").save()
            secs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(secs), 3)
    spark.stop()
    sh = _shuffle_bytes(logs)
    print(json.dumps({"orders": n, "rows": rows, "cpus": cpus, "sec": out,
                      "shuffle_bytes": {k: sh.get(f"run0:{k}", {}).get("bytes", 0) for k in out}}))


if __name__ == "__main__":
    main()
