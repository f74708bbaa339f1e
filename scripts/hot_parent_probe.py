"""Hot-parent probe: one recent order owns a third of all details.

Generates N orders with the library's generator, one of them with a third of
all details, and runs the batch fetch.  Prints one JSON line: the hot order's
pages, the largest, and whether every child is kept.

Usage: python scripts/hot_parent_probe.py N [max_children]
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fetchplan.operators import nesting  # noqa: E402
from fetchplan.session import get_spark  # noqa: E402
from fetchplan.sources import datagen  # noqa: E402

AS_OF = dt.datetime(2024, 2, 20)
HOT = 1


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    max_children = int(sys.argv[2]) if len(sys.argv) > 2 else 100_000
    max_children = max_children or None  # 0: unbounded, one row per parent
    work = tempfile.mkdtemp(prefix="fetchplan-hot-")
    spark = get_spark("local[8]", shuffle_partitions=64, app="fetchplan-hot", extra={"spark.driver.memory": "16g"})
    g = datagen.generate(spark, AS_OF, seed=3, n_departments=1, n_orders=n, hot_share=1 / 3)
    g["orders"].write.parquet(os.path.join(work, "orders"))
    g["order_details"].write.parquet(os.path.join(work, "order_details"))
    o = spark.read.parquet(os.path.join(work, "orders"))
    d = spark.read.parquet(os.path.join(work, "order_details"))
    t0 = time.perf_counter()
    nested = nesting.orders_nested_batch(o, d, AS_OF, 30, ordered=False, max_children=max_children)
    out = os.path.join(work, "nested")
    nested.write.parquet(out)
    secs = time.perf_counter() - t0
    res = spark.read.parquet(out)
    pages = [r["n"] for r in res.filter(F.col("order_id") == HOT).select(F.size("details").alias("n")).collect()]
    print(json.dumps({"orders": n, "details": d.count(), "sec": round(secs, 2), "hot_pages": len(pages),
                      "largest_page": max(pages), "hot_children_kept": sum(pages),
                      "hot_children": d.filter(F.col("order_id") == HOT).count(),
                      "other_rows": res.filter(F.col("order_id") != HOT).count()}))
    spark.stop()


if __name__ == "__main__":
    main()
