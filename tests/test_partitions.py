
import os

import pytest

from fetchplan import registry

SF = "/root/testdata/sf0.001"
NAMES = ["orders_nested_batch", "department_stats", "product_revenue", "best_method", "counter_delta",
         "variants_agree", "warm_hit_rate", "monthly_sales"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data missing")
@pytest.mark.parametrize("name", NAMES)
def test_partition_independent(spark, name):
    out = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            df = registry.QUERIES[name](spark, SF)
            out.append(sorted(map(repr, df.collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]
