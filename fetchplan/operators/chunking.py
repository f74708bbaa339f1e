"""Paged nesting: one parent's children in arrays of about ``max_children``.

An array is one value, built by one task.  A parent that holds a large share
of all children is therefore spread over pages before anything is shuffled by
parent:

* ``page_counts`` finds the parents above the bound from mergeable summaries of
  frequent keys and an exact count of what these name (``heavy``), so no row per
  parent is shuffled.  With the count it takes a sample of about ``SAMPLE`` of their children a
  page, picked by the hash of their columns, and cuts their order at its quantiles.
* ``with_page`` gives each child the page between its cut points and deals rows
  out by (parent, page), so a hot parent's rows never meet in one task.
  Children equal in all nested columns share a page.
* ``parent_pages`` repeats a parent's row once a page, so joins back to parents
  use (parent, page) too.

Everything is one lazy plan.  Pages only cut the ordered array: every child is on
exactly one page, each page is sorted, a parent's pages one after another are its
children in order, and what is computed per parent (``nesting.flatten_nested``)
is the same at any ``max_children``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fetchplan.operators.heavy import heavy_keys
from fetchplan.plans.strategy import DEFAULT_MAX_BROADCAST_BYTES, estimated_rows

DEFAULT_MAX_CHILDREN = 100_000
#: Sampled children a page; a page's size differs from the mean by about 1 / sqrt(SAMPLE) of it.
SAMPLE = 64
#: A parent has fewer pages than two to this power.
STEPS = 24
#: Bytes of a cut point with its share of a row.
CUT_BYTES = 128


@dataclass
class Pages:
    """``cuts``: (key, _cuts) of the parents with more than ``max_children`` children, at most ``most`` cut points together.

    ``_cuts`` are the ascending cut points between a parent's pages, one less than pages.  Both sides of a nesting join this
    one table, so it is computed once.
    """
    cuts: DataFrame
    most: int

    def mark(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with ``_cuts``; broadcast where the estimate of the children bounds it, else adaptive execution decides."""
        bounded = self.most * CUT_BYTES <= DEFAULT_MAX_BROADCAST_BYTES
        return df.join(F.broadcast(self.cuts) if bounded else self.cuts, key, "left")


def page_counts(children: DataFrame, key: str, max_children: int | None = DEFAULT_MAX_CHILDREN, cols: list[str] | None = None) -> Pages | None:
    """Pages of the parents with more than ``max_children`` children, in the order of ``cols`` (all others); None without a bound.  Runs no job."""
    if not max_children:
        return None
    cols = cols or [c for c in children.columns if c != key]
    # a page's share of the sample does not depend on its parent: one pass counts and samples
    chance = F.pmod(F.xxhash64(F.lit("sample"), *cols), F.lit(1 << 32)) / F.lit(float(1 << 32))
    sample = F.collect_list(F.when(chance < SAMPLE / max_children, F.struct(*cols)))
    heavy = heavy_keys(children.select(key, *cols), key, max_children, more=[F.array_sort(sample).alias("_some")])
    pages = F.ceil(F.col("row_count") / max_children).cast("int")
    cut = F.transform(F.sequence(F.lit(1), pages - 1), lambda i: F.get("_some", (i * F.size("_some") / pages).cast("int")))
    return Pages(heavy.select(key, cut.alias("_cuts")), estimated_rows(children) // max_children)


def _passed(row: Column) -> Column:
    """How many of ``_cuts`` do not lie behind ``row``, by halving steps."""
    def step(at: Column, width: Column) -> Column:
        return F.when((at + width <= F.size("_cuts")) & (F.get("_cuts", at + width - 1) <= row), at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(STEPS))]), F.lit(0), step)


def with_page(children: DataFrame, key: str, cols: list[str], pages: Pages | None) -> DataFrame:
    """Children with ``chunk``, their page number, dealt out by (key, chunk)."""
    if pages is None:
        return children.withColumn("chunk", F.lit(0)).repartition(key, "chunk")
    page = F.when(F.col("_cuts").isNull(), 0).otherwise(_passed(F.struct(*cols)))
    return pages.mark(children, key).withColumn("chunk", page).drop("_cuts").repartition(key, "chunk")


def parent_pages(parents: DataFrame, key: str, pages: Pages | None) -> DataFrame:
    """One row per parent and page (``chunk``); ``_pages`` is the number of pages."""
    if pages is None:
        marked = parents.withColumn("_pages", F.lit(1))
    else:
        marked = pages.mark(parents, key).withColumn("_pages", F.when(F.col("_cuts").isNull(), 1).otherwise(F.size("_cuts") + 1)).drop("_cuts")
    return marked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_pages") - 1)))
