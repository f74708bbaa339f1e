"""Static checks of the library source: no Python UDFs, no RDD code, no local checkpoints."""

import pathlib
import re

SRC = pathlib.Path(__file__).resolve().parent.parent / "fetchplan"


def test_no_udf_rdd_or_local_checkpoint():
    bad = []
    for p in SRC.rglob("*.py"):
        text = p.read_text()
        for pat in (r"\budf\(", r"pandas_udf", r"\.rdd\b", r"mapPartitions", r"localCheckpoint",
                    r"crossJoin", r"\.toPandas\("):
            if re.search(pat, text):
                bad.append((p.name, pat))
    assert bad == []
