"""Look-backs from sums kept per day, and exact sets that merge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fetchplan.operators import aggregates as A
from fetchplan.operators import daily as D
from fetchplan.operators import distinct_sets as S
from fetchplan.plans.variants import compare_pair, plan_text

AS_OFS = [dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1, 13, 7, 5), dt.datetime(2024, 5, 31, 23, 59, 59), dt.datetime(2030, 1, 1), dt.datetime(2023, 1, 1)]


@pytest.fixture(scope="module")
def orders(spark):
    """Orders of 200 days at all hours; null dates, amounts and customers, negative and huge customers."""
    k = F.col("id")
    customer = (F.when(k % 53 == 0, F.lit(None)).when(k % 47 == 0, -(k % 130)).when(k % 43 == 0, F.lit(2**62) + k % 5).otherwise(k % 300))
    date = F.when(k % 31 != 0, F.timestamp_seconds(F.lit(1704067200) + k * 12_345 % (200 * 86_400)).cast("timestamp_ntz"))
    return spark.range(4000, numPartitions=5).select(
        k.alias("order_id"), customer.cast("bigint").alias("customer_id"), date.alias("order_date"),
        F.when(k % 29 != 0, (k % 997) / 7).cast("decimal(12,2)").alias("total_amount"), F.lit("x").alias("status"))


@pytest.fixture(scope="module")
def kept(spark, orders, tmp_path_factory):
    folder = tmp_path_factory.mktemp("daily")
    orders.write.parquet(f"{folder}/orders")
    for name, table in (("sales", D.daily_sales(orders)), ("sets", D.daily_customers(orders))):
        D.write_daily(table, f"{folder}/{name}")
    return {"folder": folder, "orders": spark.read.parquet(f"{folder}/orders"), "sales": D.read_daily(spark, f"{folder}/sales"),
            "sets": D.read_daily(spark, f"{folder}/sets")}


@pytest.mark.parametrize("as_of", AS_OFS)
@pytest.mark.parametrize("days", [0, 45])
def test_look_backs_equal_those_over_all_orders(kept, as_of, days):
    o, sales = kept["orders"], kept["sales"]
    pairs = [(A.customer_sales(o, as_of, days), D.customer_sales(sales, o, as_of, days)),
             (A.customer_sales(o, as_of, days, with_avg=False), D.customer_sales(sales, o, as_of, days, with_avg=False)),
             (A.customer_order_counts(o, as_of, days), D.customer_order_counts(sales, o, as_of, days)),
             (A.monthly_sales(o, as_of, days), D.monthly_sales(sales, o, as_of, days)),
             (A.recent_order_count(o, as_of, days), D.recent_order_count(sales, o, as_of, days))]
    for want, got in pairs:
        ordered = "order_count" not in want.columns[1:2] or len(want.columns) > 2  # counts come in any order
        rows = (lambda df: df.collect()) if ordered else (lambda df: sorted(map(repr, df.collect())))
        assert got.dtypes == want.dtypes and rows(got) == rows(want)
    exact = o.where(F.col("order_date") >= F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")).agg(F.countDistinct("customer_id")).first()[0]
    assert D.unique_customers(kept["sets"], o, as_of, days).first().unique_customers == exact


def test_only_the_cutoff_day_is_read(kept):
    """The orders' scan is bounded on both sides; the table's reads no earlier month."""
    plan = plan_text(D.customer_order_counts(kept["sales"], kept["orders"], dt.datetime(2024, 3, 1, 12), 30)).replace("\n", " ")
    assert "GreaterThanOrEqual(order_date,2024-01-31T12:00), LessThan(order_date,2024-02-01T00:00)" in plan
    assert "GreaterThan(order_day,2024-01-31)" in plan and "order_month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_table_that_lags_behind(spark, orders, tmp_path):
    """Days after the last one kept are read from the orders; a later refresh rewrites its months alone."""
    path = str(tmp_path / "sales")
    march = F.col("order_date") < F.lit(dt.datetime(2024, 3, 11)).cast("timestamp_ntz")
    D.write_daily(D.daily_sales(orders.where(march)), path)
    want = A.customer_sales(orders, AS_OFS[1], 45).collect()
    assert D.customer_sales(D.read_daily(spark, path), orders, AS_OFS[1], 45, through=dt.date(2024, 3, 10)).collect() == want
    before = {f.name for f in (tmp_path / "sales" / "order_month=2024-02").glob("*.parquet")}
    D.write_daily(D.daily_sales(orders).where("order_day >= date'2024-03-01'"), path)
    assert {f.name for f in (tmp_path / "sales" / "order_month=2024-02").glob("*.parquet")} == before
    assert D.customer_sales(D.read_daily(spark, path), orders, AS_OFS[1], 45).collect() == want


def test_sets_merge_to_distinct_counts(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 1000 - 200).alias("v"), (F.col("id") % 3).alias("part"))
    rows = rows.union(spark.createDataFrame([(9, None, 0), (8, 2**63 - 1, 0), (8, -2**63, 1), (8, 2**63 - 1, 2)], "k long, v long, part long"))
    sets = S.value_sets(rows, ["k", "part"], "v")
    assert compare_pair(S.set_sizes(sets, ["k"], "n"), rows.where("v is not null").groupBy("k").agg(F.countDistinct("v").alias("n"))).first().agree
    assert S.set_sizes(sets, [], "n").first().n == rows.agg(F.countDistinct("v")).first()[0]
    dense = S.value_sets(spark.range(6400), [], "id")
    assert dense.count() == 100 and S.set_sizes(dense, []).first().members == 6400


def test_monthly_customers_are_not_shuffled_as_pairs(orders):
    plan = plan_text(A.monthly_sales(orders, AS_OFS[1], 45))
    assert "bit_or" in plan and "distinct" not in plan.lower().split("== physical plan ==")[1]
    assert "SortAggregate" not in plan and "Expand" not in plan
