"""Predicates that share a table's rows evenly; repeated keys found without shuffling every key."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fetchplan.operators import quality as Q
from fetchplan.plans.variants import plan_text
from fetchplan.sources.partitioning import balanced_predicates, literal, range_predicates


def per_predicate(df, predicates):
    """Rows of each predicate; asserts that every row satisfies exactly one."""
    hits = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    assert df.where(sum(hits[1:], hits[0]) != 1).count() == 0
    return df.agg(*[F.sum(h).alias(f"p{k}") for k, h in enumerate(hits)]).first()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Keys crowded at the low end of a wide range, one of them with a third of all rows; some null."""
    folder = tmp_path_factory.mktemp("rows")
    k = F.col("id")
    key = F.when(k % 3 == 0, 777).when(k % 101 == 0, F.lit(None)).when(k % 89 == 0, k * 1_000_000).otherwise(k % 5000)
    spark.range(30_000).select(key.cast("bigint").alias("key"), (k % 1000 - 500).alias("line"),
                               F.date_add(F.lit(dt.date(2024, 1, 1)), (k % 300).cast("int")).alias("day"),
                               F.timestamp_seconds(k * k).cast("timestamp_ntz").alias("at"),
                               (k % 900 / 7).cast("decimal(8,2)").alias("amount")).write.parquet(f"{folder}/t")
    return spark.read.parquet(f"{folder}/t")


def test_skewed_key_is_shared_evenly(skewed):
    strides = range_predicates("key", [k * 30_000_000_000 // 12 for k in range(1, 12)])
    assert max(per_predicate(skewed, strides)) > 25_000  # equal strides: nearly all in one connection
    even = balanced_predicates(skewed, "key", 12, second="line")
    sizes = per_predicate(skewed, even)
    assert 12 <= len(even) <= 16 and max(sizes) < 2 * 30_000 / 12
    whole = per_predicate(skewed, balanced_predicates(skewed, "key", 12))
    assert sorted(whole)[-1] >= 10_000 and sorted(whole)[-2] < 2 * 30_000 / 12  # one value cannot be cut by its key


@pytest.mark.parametrize("column", ["key", "line", "day", "at", "amount"])
@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_every_row_in_exactly_one(skewed, column, parts):
    sizes = per_predicate(skewed, balanced_predicates(skewed, column, parts, second="line" if column != "line" else None))
    assert sum(sizes) == 30_000


def test_odd_tables(spark, skewed):
    none = skewed.where("false")
    assert len(balanced_predicates(none, "key", 5)) == 1 and balanced_predicates(skewed, "key", 1) == ["1 = 1"]
    nulls = skewed.select(F.lit(None).cast("bigint").alias("key"))
    assert sum(per_predicate(nulls, balanced_predicates(nulls, "key", 4))) == 30_000
    same = skewed.select(F.lit(5).alias("key"), F.lit(6).alias("line"))
    assert sum(per_predicate(same, balanced_predicates(same, "key", 4, second="line"))) == 30_000


def test_literals():
    assert literal(dt.datetime(2024, 1, 2, 3, 4, 5)) == "TIMESTAMP '2024-01-02 03:04:05'" and literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'"
    assert literal(-5) == "-5" and literal(Decimal("1.50")) == "1.50"
    for bad in ("x'; drop", True, None):
        with pytest.raises(ValueError):
            literal(bad)


def test_repeated_keys(spark):
    """Single, repeated, negative, extreme and null keys of any integer type, as from one grouping of all keys."""
    k = F.col("id")
    rows = spark.range(5000, numPartitions=4).select(
        F.when(k % 97 == 0, k % 500 - 250).when(k % 101 == 0, F.lit(2**63 - 1)).when(k == 7, F.lit(-2**63)).when(k % 499 == 0, F.lit(None)).otherwise(k).alias("k"))
    for df in (rows, rows.select((F.col("k") % 30_000).cast("int").alias("k"))):
        want = df.groupBy("k").count().where("count > 1 or k is null").count()
        got = Q.pk_violations(df, "t", ["k"])
        plain = Q.pk_violations(df.select(F.col("k").cast("decimal(20,0)").alias("k")), "t", ["k"])
        assert got.count() == want and sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
        assert Q.unique_violations(df, "t", ["k"]).count() == df.groupBy("k").count().where("count > 1 and k is not null").count()
    assert Q.pk_violations(spark.range(1000), "t", ["id"]).collect() == []


def test_clean_keys_are_not_grouped_one_by_one(spark, tmp_path):
    """What stands below the first exchange of a clean table is one row per 64 keys."""
    spark.range(64_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert Q.pk_violations(df, "t", ["id"]).collect() == []
    plan = plan_text(Q.pk_violations(df, "t", ["id"]))
    assert "bit_or" in plan and "bit_xor" in plan
    words = df.groupBy(F.shiftright("id", 6).alias("w")).count()
    assert words.count() == 1000
