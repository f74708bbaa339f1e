"""Property tests: random fixtures against brute-force Python versions of the
reference's loops (hypothesis; few examples, each runs Spark jobs)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fetchplan.functions.scalar import oracle_num
from fetchplan.operators import measure as M
from fetchplan.operators import nesting
from fetchplan.sources.tables import ORDER_DETAILS, ORDERS

AS_OF = dt.datetime(2024, 2, 20)
SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=list(HealthCheck))


def close4(a, b):
    """Equal as values rounded to 4 places (engines may break exact .5 ties differently)."""
    if a is None or b is None:
        return a is b
    return abs(a - b) <= 1.01e-4


orders_st = st.lists(st.tuples(st.integers(0, 40), st.integers(1, 5)), min_size=1, max_size=12,
                     unique_by=lambda t: t[0])
details_st = st.lists(st.tuples(st.integers(0, 45), st.integers(1, 9), st.integers(1, 20)),
                      max_size=60)


@SETTINGS
@given(orders_st, details_st, st.sampled_from([None, 1, 2, 3]))
def test_three_shapes_match_brute_force(spark, orders, details, max_children):
    o = spark.createDataFrame(
        [(oid, c, "c", AS_OF - dt.timedelta(days=oid), Decimal("1.00"), "P") for oid, c in orders], ORDERS)
    d = spark.createDataFrame(
        [(i + 1, oid, p, "p", q, Decimal("2.50")) for i, (oid, p, q) in enumerate(details)], ORDER_DETAILS)
    recent = sorted(oid for oid, _ in orders if oid <= 30)
    want = {oid: sorted(i + 1 for i, (x, _, _) in enumerate(details) if x == oid) for oid in recent}
    for fn in (nesting.orders_nested_join, nesting.orders_nested_batch, nesting.orders_nested_lateral):
        got, seen = {oid: [] for oid in recent}, []
        for r in fn(o, d, AS_OF, 30, max_children=max_children).collect():
            ids = [x["detail_id"] for x in r["details"]]
            assert ids == sorted(ids)
            seen.append((r["order_id"], r["chunk"]))
            got[r["order_id"]] += ids
            pages = -(-len(want[r["order_id"]]) // max_children) if max_children else 1
            assert 0 <= r["chunk"] < max(1, pages)
        assert seen == sorted(set(seen)) and {oid: sorted(x) for oid, x in got.items()} == want, fn.__name__


runs_st = st.lists(st.tuples(st.integers(0, 3), st.floats(0, 100, allow_nan=False).map(lambda x: round(x, 2)),
                             st.booleans()), min_size=1, max_size=40)


@SETTINGS
@given(runs_st)
def test_run_statistics_match_go_loops(spark, runs):
    data = [(f"g{g}", i, ms, hit) for i, (g, ms, hit) in enumerate(runs)]
    log = spark.createDataFrame(data, "grp string, run_no int, exec_ms double, hit boolean")
    warm = {r["grp"]: r for r in M.warm_hit_rate(log).collect()}
    rate = {r["grp"]: r for r in M.hit_rate(log).collect()}
    ns = spark.createDataFrame([(g, i, int(ms * 1e6)) for g, i, ms, _ in data], "suite string, seq int, exec_ns bigint")
    mean = {r["suite"]: r["mean_ns"] for r in M.mean_run_time(ns).collect()}
    for g in {x[0] for x in data}:
        rows = sorted((i, ms, hit) for gg, i, ms, hit in data if gg == g)
        # the reference: a run after the first and under 50 ms counts as a hit
        hits = sum(1 for k, (_, ms, _) in enumerate(rows) if k > 0 and ms < 50)
        n = len(rows)
        assert warm[g]["warm_hits"] == hits
        assert close4(warm[g]["warm_hit_rate"], None if n == 1 else hits / (n - 1) * 100)
        assert close4(rate[g]["hit_rate"], sum(h for _, _, h in rows) / n * 100)
        assert mean[g] == sum(int(ms * 1e6) for _, ms, _ in rows) // n


snap_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 10_000), st.integers(0, 10_000),
                             st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=20)


@SETTINGS
@given(snap_st)
def test_counter_delta_matches_brute_force(spark, snaps):
    base = dt.datetime(2024, 1, 1)
    data = [(f"s{s}", base + dt.timedelta(minutes=i // 2), i, float(i % 100), lr, pr, obj, cr)
            for i, (s, lr, pr, obj, cr) in enumerate(snaps)]
    df = spark.createDataFrame(data, "source string, taken_at timestamp_ntz, snapshot_no bigint, buffer_hit_ratio double, "
                                     "logical_reads bigint, physical_reads bigint, objects bigint, created bigint")
    for c in [*M._DELTAS, *M._FINALS]:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0).cast("bigint"))
    got = {r["source"]: r for r in M.counter_delta(df).collect()}
    for s in {x[0] for x in data}:
        rows = [x for x in data if x[0] == s]
        i, f = rows[0], rows[-1]
        dl, dp, dc, do = f[4] - i[4], f[5] - i[5], f[7] - i[7], f[6] - i[6]
        ratio = (1 - dp / dl) * 100 if dl > 0 else f[3]
        assert close4(got[s]["buffer_hit_ratio"], ratio)
        assert (got[s]["cache_hits"], got[s]["cache_misses"]) == ((do * 2, dc) if dc > 0 else (0, 0))


@SETTINGS
@given(st.lists(st.decimals(min_value=-99999, max_value=99999, places=2, allow_nan=False), min_size=1,
                max_size=20))
def test_oracle_number_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(12,2)")
    got = [r["s"] for r in df.select(oracle_num(F.col("x")).alias("s")).collect()]

    def oracle(v: Decimal) -> str:
        s = format(v, "f")
        if "." in s:
            s = s.rstrip("0").rstrip(".")
        if s.startswith("0."):
            s = s[1:]
        if s.startswith("-0."):
            s = "-" + s[2:]
        return "0" if s in ("", "-0") else s

    assert got == [oracle(v) for v in values]
