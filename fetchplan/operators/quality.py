"""DDL constraints as data checks.

Each check returns the violating keys or an unpivoted per-column count; an
empty result means the rule holds.  All are single aggregations or anti joins
over the whole table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fetchplan.functions.scalar import ntz
from fetchplan.operators.distinct_sets import word
from fetchplan.sources.tables import ORDERS


def _key_text(keys: list[str]):
    """The key as JSON, NULLs included: different keys never read the same."""
    return F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})


def _repeated(df: DataFrame, key: str) -> DataFrame:
    """(key, row_count) of the values of a whole-number column that occur more than once, without shuffling every key.

    A first pass reduces 64 neighbouring keys to one row: a word of bits, their
    parities and a count.  A word with as many bits as rows holds no repeat.  Of other words a second
    pass groups the keys whose bit has an even parity, if these explain the count (each stands twice), else all.
    """
    place = F.col(key).cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    present = df.where(F.col(key).isNotNull()).select(key, word(key).alias("_word"), bit.alias("_bit"))
    words = present.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"), F.bit_xor("_bit").alias("_odd"), F.count(F.lit(1)).alias("_rows"))
    even = F.col("_bits").bitwiseAND(F.bitwise_not("_odd"))
    doubtful = words.where(F.col("_rows") > F.bit_count("_bits")).select(
        "_word", F.when(F.col("_rows") - F.bit_count("_bits") == F.bit_count(even), even).otherwise(F.col("_bits")).alias("_doubt"))
    again = present.join(doubtful, "_word").where(F.col("_doubt").bitwiseAND(F.col("_bit")) != 0)
    return again.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def pk_violations(df: DataFrame, table: str, keys: Iterable[str]) -> DataFrame:
    """Q1: primary-key values that occur more than once or contain a NULL."""
    keys = list(keys)
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, T.IntegralType):
        nulls = df.where(F.col(keys[0]).isNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        found = _repeated(df, keys[0]).unionByName(nulls)
    else:
        has_null = F.lit(False)
        for k in keys:
            has_null = has_null | F.col(k).isNull()
        found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter((F.col("row_count") > 1) | has_null)
    return found.select(F.lit(table).alias("table_name"), _key_text(keys).alias("key_value"), "row_count")


def unique_violations(df: DataFrame, table: str, cols: Iterable[str]) -> DataFrame:
    """Q2: UNIQUE values that repeat.  NULLs are allowed by UNIQUE (Q3 bars them)."""
    cols = list(cols)
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, T.IntegralType):
        found = _repeated(df, cols[0])
    else:
        found = df.filter(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    return found.select(
        F.lit(table).alias("table_name"), F.lit(",".join(cols)).alias("column_name"),
        _key_text(cols).alias("key_value"), "row_count")


def null_counts(df: DataFrame, table: str, cols: Iterable[str]) -> DataFrame:
    """NULL count of each column in one pass, unpivoted to (table, column, count)."""
    cols = list(cols)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.select(F.lit(table).alias("table_name"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols
    ])).alias("x")).select("table_name", "x.column_name", "x.null_count")


def null_violations(df: DataFrame, table: str, cols: Iterable[str]) -> DataFrame:
    """Q3: NOT NULL columns that hold NULLs, with the count."""
    return null_counts(df, table, cols).filter(F.col("null_count") > 0)


def limit_violations(df: DataFrame, table: str, varchar: dict[str, int] | None = None,
                     number: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Q4: VARCHAR2(n) lengths (characters) and NUMBER(p,s) bounds, per column.

    Columns are read as they are, so a value that the declared type can't hold
    is reported and not raised.  A NUMBER(p,s) value must be a number with
    |x| < 10^(p-s) and at most s decimals.
    """
    checks = []
    for c, n in (varchar or {}).items():
        checks.append((c, f"length>{n}", F.length(F.col(c).cast("string")) > F.lit(n)))
    for c, (p, s) in (number or {}).items():
        x = F.col(c).try_cast("decimal(38,10)")
        bad = x.isNull() | (F.abs(x) >= F.lit(10 ** (p - s)).cast("decimal(38,10)")) | (x != F.round(x, s))
        checks.append((c, f"number({p},{s})", F.col(c).isNotNull() & bad))
    if not checks:
        raise ValueError("no limits to check")
    one = df.agg(*[F.count_if(cond).alias(f"_{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                              F.col(f"_{i}").alias("violations"))
                     for i, (c, rule, _) in enumerate(checks)])
    return (one.select(F.lit(table).alias("table_name"), F.explode(rows).alias("x"))
            .select("table_name", "x.column_name", "x.rule", "x.violations")
            .filter(F.col("violations") > 0))


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (NULL FK is valid)."""
    keys = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def cascade_delete(children: DataFrame, deleted_parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """ON DELETE CASCADE: children that remain after the parents are deleted."""
    keys = deleted_parents.select(F.col(pk).alias("_pk"))
    return children.join(keys, F.col(fk) == F.col("_pk"), "left_anti")


class _Now:
    """Marks a default that is the time of the insert (SYSDATE)."""


NOW = _Now()


def apply_defaults(df: DataFrame, defaults: dict, schema: T.StructType = ORDERS, now: _dt.datetime | None = None) -> DataFrame:
    """Add each defaulted column that the insert omitted, in its declared type.

    ``defaults`` maps a column to a value or ``NOW``.  A column that is present
    keeps its values, an explicit NULL included.
    """
    now = now or _dt.datetime.now().replace(microsecond=0)
    present = {c.lower() for c in df.columns}
    for col, val in defaults.items():
        if col.lower() not in present:
            df = df.withColumn(col, (ntz(now) if val is NOW else F.lit(val)).cast(schema[col].dataType))
    return df


# DDL defaults of the orders table, fixed values.
ORDER_DEFAULTS = {"order_date": NOW, "total_amount": 0, "status": "PENDING"}
