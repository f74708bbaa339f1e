"""Balanced reads of a database table: one predicate a connection, cut at the quantiles of a key.

Equal strides between a key's smallest and largest value, which partition bounds
give, put most rows of a skewed key into a few connections.  ``balanced_predicates``
looks at the key column once and cuts it where the rows are.  A value that holds
several connections' rows gets predicates of its own, split by a second column
where one is named.  Every row satisfies exactly one predicate, nulls included.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative error of the quantiles is one in this many rows.
ACCURACY = 10_000


def literal(value) -> str:
    """A cut point as an SQL literal."""
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise ValueError(f"no range of a connection can end at {value!r}")
    return str(value)


def range_predicates(column: str, cuts: list, alone: list = ()) -> list[str]:
    """Predicates of the ranges between ascending cut points; values in ``alone`` (cut points, too) stand by themselves.

    NULLs belong to the first range.
    """
    cuts, out, below = sorted(set(cuts)), [], None
    for cut in [*cuts, None]:
        lower = None if below is None else f"{column} {'>' if below in alone else '>='} {literal(below)}"
        upper = None if cut is None else f"{column} < {literal(cut)}"
        both = " AND ".join(x for x in (lower, upper) if x) or "1 = 1"
        out.append(f"({both}) OR {column} IS NULL" if below is None else both)
        if cut is not None and cut in alone:
            out.append(f"{column} = {literal(cut)}")
        below = cut
    return out


def _ranks(parts: int) -> list[float]:
    return [k / parts for k in range(1, parts)]


def balanced_predicates(keys: DataFrame, column: str, parts: int, second: str | None = None) -> list[str]:
    """About ``parts`` predicates over ``column`` that share the rows of ``keys`` evenly.

    ``keys`` holds the key column (and ``second``): the table itself, or a light
    query of these columns.  Two aggregates run; at most ``parts`` cut points, and as many
    again for the values that need a split, reach the driver.
    """
    if parts < 2:
        return ["1 = 1"]
    ranks = F.array(*[F.lit(r) for r in _ranks(parts)])
    found = keys.agg(F.percentile_approx(column, ranks, ACCURACY)).first()[0] or []
    alone = sorted({v for v in found if found.count(v) > 1})
    out = range_predicates(column, found, alone)
    if not second or not alone:
        return out
    shares = {v: found.count(v) for v in alone}
    hot = keys.where(F.col(column).isin(alone)).groupBy(column).agg(
        F.percentile_approx(second, ranks, ACCURACY).alias("cuts")).collect()
    for row in hot:
        value, n = row[0], shares[row[0]]
        # every so-and-so-many-th of the parts' quantiles cuts the value's rows into n ranges
        cuts = [row.cuts[k * parts // n - 1] for k in range(1, n)] if row.cuts else []
        at = out.index(f"{column} = {literal(value)}")
        out[at:at + 1] = [f"{column} = {literal(value)} AND ({p})" for p in range_predicates(second, cuts)]
    return out
