"""Variant agreement (M18) and physical-plan checks.

The reference prints each variant's row count and never compares contents.
``variants_agree`` compares contents too: per pair, the row counts and the
multiset difference both ways (EXCEPT ALL semantics).  It first takes every
variant's fingerprint, which shuffles one row a task and variant: the row count and the sums
of two 64-bit hashes of each row, the same in any order and partitioning.  Pairs of
equal fingerprints agree.  Only for the others the rows themselves are grouped,
one tagged union per column set, for exact differences.  A nested result is compared as its
parent and child rows (``nesting.child_rows``), so that no array is a grouping key.

``plan_text`` / ``plan_has`` read the formatted physical plan, for tests that
assert a pushed filter, a broadcast semi join or the absence of a nested-loop
join.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _compare_group(variants: dict[str, DataFrame], names: list[str], cols: list[str],
                   pairs: list[tuple[str, str]]) -> DataFrame:
    """All pairs among variants with the same columns, from one grouping.

    Every variant is tagged and unioned once, grouped by every column with a
    row count per variant, and folded to per-pair numbers with the EXCEPT ALL
    multiset rule (a row present n times in a and m times in b counts
    max(n - m, 0) towards ``only_in_a``).  Each variant is computed once.
    """
    idx = {n: i for i, n in enumerate(names)}
    u = None
    for n in names:
        part = variants[n].select(*cols, F.lit(idx[n]).alias("_v"))
        u = part if u is None else u.unionByName(part)
    g = u.groupBy(*cols).agg(*[F.count_if(F.col("_v") == i).alias(f"_n{i}") for i in idx.values()])
    aggs = [F.sum(f"_n{i}").alias(f"rows{i}") for i in idx.values()]
    for a, b in pairs:
        ia, ib = idx[a], idx[b]
        aggs.append(F.sum(F.greatest(F.col(f"_n{ia}") - F.col(f"_n{ib}"), F.lit(0))).alias(f"only{ia}_{ib}"))
        aggs.append(F.sum(F.greatest(F.col(f"_n{ib}") - F.col(f"_n{ia}"), F.lit(0))).alias(f"only{ib}_{ia}"))
    t = g.agg(*aggs)

    def num(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    items = []
    for a, b in pairs:
        ia, ib = idx[a], idx[b]
        ra, rb, oa, ob = num(f"rows{ia}"), num(f"rows{ib}"), num(f"only{ia}_{ib}"), num(f"only{ib}_{ia}")
        items.append(F.struct(F.lit(a).alias("variant_a"), F.lit(b).alias("variant_b"),
                              ra.alias("rows_a"), rb.alias("rows_b"), oa.alias("only_in_a"),
                              ob.alias("only_in_b"), ((ra == rb) & (oa == 0) & (ob == 0)).alias("agree")))
    return t.select(F.explode(F.array(*items)).alias("p")).select("p.*")


PAIR_SCHEMA = "variant_a string, variant_b string, rows_a bigint, rows_b bigint, only_in_a bigint, only_in_b bigint, agree boolean"


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row over its columns in the order of their names.

    A hash passes over nulls, so which columns are null is hashed as well; structs are hashed as JSON, nulls included.
    """
    cols = [F.to_json(F.col(c), {"ignoreNullFields": "false"}) if kind.startswith(("struct", "map")) else F.col(c)
            for c, kind in sorted(df.dtypes)]
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in sorted(df.columns)])
    return [F.xxhash64(nulls, *cols), F.xxhash64(F.lit("second"), *cols, nulls)]


def fingerprints(variants: dict[str, DataFrame]) -> DataFrame:
    """(variant, row_count, hash_1, hash_2) per variant: equal for equal multisets of rows, in any order.

    Hashes are summed as decimals, so no order of addition and no overflow shows.  Different
    multisets of rows have equal fingerprints with a chance of 2 ** -128.  Columns of other types give other hashes.
    """
    parts = None
    for name, df in variants.items():
        one, two = _row_hashes(df)
        part = df.select(F.lit(name).alias("variant"), one.cast("decimal(20,0)").alias("h1"), two.cast("decimal(20,0)").alias("h2"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("variant").agg(F.count(F.lit(1)).alias("row_count"), F.sum("h1").alias("hash_1"), F.sum("h2").alias("hash_2"))


def variants_agree(variants: dict[str, DataFrame], pairs=None) -> DataFrame:
    """One row per pair: rows of each side, rows only in a, only in b, agree.

    ``variants`` maps a name to a DataFrame; the two sides of a pair must have
    the same columns (compared by name) and hold no arrays.  ``pairs`` defaults to
    the first variant against each other one.  Runs one job, whose result is one row a
    variant; variants of pairs that differ are computed once more.
    """
    names = list(variants)
    if pairs is None:
        pairs = [(names[0], n) for n in names[1:]]
    for a, b in pairs:
        if sorted(variants[a].columns) != sorted(variants[b].columns):
            raise ValueError(f"variants {a!r} and {b!r} have different columns")
        if any(kind.startswith("array") for _, kind in variants[a].dtypes):
            raise ValueError(f"variants {a!r} and {b!r} are nested: compare their child rows")
    spark = variants[names[0]].sparkSession
    used = dict.fromkeys(n for p in pairs for n in p)
    found = {r.variant: tuple(r)[1:] for r in fingerprints({n: variants[n] for n in used}).collect()}
    empty = (0, None, None)
    same, groups = [], {}
    for a, b in pairs:
        one, two = found.get(a, empty), found.get(b, empty)
        if one == two:
            same.append((a, b, one[0], two[0], 0, 0, True))
        else:
            groups.setdefault(tuple(sorted(variants[a].columns)), []).append((a, b))
    out = spark.createDataFrame(same, PAIR_SCHEMA)
    for cols, group_pairs in groups.items():
        members = list(dict.fromkeys(n for p in group_pairs for n in p))
        out = out.unionByName(_compare_group(variants, members, list(cols), group_pairs))
    return out


def compare_pair(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> DataFrame:
    """Rows of each side and the multiset differences both ways, one row."""
    return variants_agree({name_a: a, name_b: b}, [(name_a, name_b)])


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``df.explain(mode)`` prints it (AQE's initial plan)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_has(df: DataFrame, *needles: str) -> bool:
    text = plan_text(df)
    return all(n in text for n in needles)
