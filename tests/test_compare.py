"""Plan-shape comparison job (the reference's main flow) on the seed data."""

import os
import tempfile

from conftest import SEED_AS_OF
from fetchplan.plans import compare


def test_compare_order_shapes(spark, seed):
    out = compare.compare_order_shapes(spark, seed["orders"], seed["order_details"], SEED_AS_OF, 30)
    runs = out["runs"].collect()
    assert [r["method"] for r in runs] == ["per_parent", "join", "batch"]
    assert all(r["record_count"] == 4 and r["exec_ns"] > 0 for r in runs)
    assert all(r["agree"] for r in out["agree"].collect())
    sp = {r["method"]: r["speedup"] for r in out["speedup"].collect()}
    assert sp["per_parent"] is None and sp["join"] > 0 and sp["batch"] > 0
    assert out["best"].first()["best_method"] in ("join", "batch")


def test_compare_employee_shapes_cli(spark, seed):
    from fetchplan.__main__ import main
    base = tempfile.mkdtemp(prefix="fetchplan-cli-")
    for name, df in seed.items():
        df.write.mode("overwrite").parquet(os.path.join(base, f"{name}.parquet"))
    main(["employees", "--path", base])
    out = compare.compare_employee_shapes(spark, seed["employees"], seed["departments"])
    assert all(r["agree"] and r["rows_a"] == 7 for r in out["agree"].collect())


def test_cli_orders_mode(spark, seed, capsys):
    from fetchplan.__main__ import main
    base = tempfile.mkdtemp(prefix="fetchplan-cli-o-")
    for name, df in seed.items():
        df.write.mode("overwrite").parquet(os.path.join(base, f"{name}.parquet"))
    main(["orders", "--path", base, "--as-of", "2024-06-30 00:00:00", "--days", "30"])
    out = capsys.readouterr().out
    assert "-- runs" in out and "per_parent" in out and "batch" in out and "-- agree" in out
