"""Keys with more than a given number of rows, without one shuffled row per key.

Keys are dealt over ``PARTS`` parts by their hash.  Each task keeps a
frequent-items summary per part: at most ``items`` keys with an estimated count.
Summaries of one part merge, and the merged one names every key that has more than
twice ``ERROR / size`` of the part's rows.  What it names is counted exactly in a second
pass over the key column.  Where ``above`` rows are too small a share of a
part for its summary to vouch for them, the second pass counts every key of that
part instead: the same rows either way, decided inside the plan from the part's row count.

Only summaries and the candidates' partial counts are shuffled: their size depends
on the number of tasks and on ``items``, not on the number of keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a frequent-items summary of size s errs by at most ERROR / s of its rows.
ERROR = 3.5
PARTS = 16
DEFAULT_ITEMS = 1024
#: Candidates of all parts are broadcast: PARTS * MAX_ITEMS keys at most.
MAX_ITEMS = 16_384


def summary_size(items: int) -> int:
    """Slots of a summary that tracks ``items`` keys: at most three quarters of a power of two are used."""
    return 1 << (max(8, -(-4 * items // 3)) - 1).bit_length()


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def frequent_summary(df: DataFrame, key: str, items: int = DEFAULT_ITEMS) -> DataFrame:
    """(part, summary, n): per part of the non-null keys, their summary and how many rows they have."""
    return df.where(F.col(key).isNotNull()).groupBy(_part(F.col(key)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {items})").alias("summary"), F.count(F.lit(1)).alias("n"))


def merge_summaries(summaries: DataFrame, items: int = DEFAULT_ITEMS) -> DataFrame:
    """Summaries of several tables, or of a table's days kept as rows, as those of all their rows."""
    return summaries.groupBy("part").agg(F.expr(f"approx_top_k_combine(summary, {items})").alias("summary"), F.sum("n").alias("n"))


def candidates(summaries: DataFrame, above: int, items: int = DEFAULT_ITEMS) -> DataFrame:
    """(part, vouched, keys): the keys that may have more than ``above`` rows, all of them if ``vouched``."""
    named = F.expr(f"approx_top_k_estimate(summary, {items})")
    return summaries.select(
        "part", (F.col("n") * F.lit(2 * ERROR / summary_size(items)) <= F.lit(above)).alias("vouched"),
        F.transform(F.filter(named, lambda c: c["count"] > above), lambda c: c["item"]).alias("keys"))


def heavy_keys(df: DataFrame, key: str, above: int, items: int = DEFAULT_ITEMS, summaries: DataFrame | None = None,
               more: Iterable[Column] = ()) -> DataFrame:
    """(``key``, ``row_count``) of every non-null key with more than ``above`` rows; exact for any data and ``items``.

    ``summaries`` (of ``df``, with the same ``items``) saves the first pass; ``more`` are further aggregates of a heavy key's rows.
    """
    if not 1 <= items <= MAX_ITEMS:
        raise ValueError(f"items must be 1 to {MAX_ITEMS}")
    picks = candidates(frequent_summary(df, key, items) if summaries is None else summaries, above, items)
    rows = df.where(F.col(key).isNotNull()).withColumn("part", _part(F.col(key)))
    # a row a part: bounded by PARTS * items keys
    rows = rows.join(F.broadcast(picks), "part").where(~F.col("vouched") | F.array_contains("keys", F.col(key)))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"), *more).where(F.col("row_count") > above)
