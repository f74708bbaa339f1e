"""Exact sets of whole numbers that merge: 64 neighbours a row.

A value v is bit v mod 64 of word v div 64, so a set is a few rows (word, bits).  Sets
of parts of a table, of its days for instance, merge by the bitwise or of equal words and are counted by
their bits: the number is COUNT(DISTINCT), for any union of parts, and never the parts' numbers added.
There is at most one row per value, and one per 64 where values lie dense; all of it aggregates by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.shiftright(value.cast("bigint"), 6)


def bits(value: str | Column) -> Column:
    """Aggregate: the bits of the values of one word; NULL where all are NULL."""
    value = F.col(value) if isinstance(value, str) else value
    place = value.cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))


def members(column: str = "bits") -> Column:
    """Aggregate: how many values the (merged) words hold."""
    return F.coalesce(F.sum(F.bit_count(F.col(column))), F.lit(0)).cast("bigint")


def value_sets(df: DataFrame, keys: list, value: str) -> DataFrame:
    """(keys, word, bits): per key the set of the non-null values of a whole-number column."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, word(value).alias("word")).agg(bits(value).alias("bits"))


def merge_sets(sets: DataFrame, keys: list) -> DataFrame:
    """(keys, word, bits) of the unions, for keys coarser than those of ``sets``."""
    return sets.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def set_sizes(sets: DataFrame, keys: list, name: str = "members") -> DataFrame:
    """(keys, ``name``): the number of distinct values per key, whatever finer keys ``sets`` have."""
    return merge_sets(sets, keys).groupBy(*keys).agg(members().alias(name))
