"""Column helpers for the scalar functions the workload uses.

All helpers build JVM-side ``Column`` expressions; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or text.

    Built from text, so the wall-clock value never passes through the session
    or process time zone.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = f"{value.isoformat()} 00:00:00"
    return F.lit(str(value)).cast("timestamp_ntz")


def _lit_ts(as_of) -> Column:
    return ntz(as_of)


def cutoff(as_of, days: int) -> Column:
    """``as_of - days`` to the second, keeping TIMESTAMP_NTZ.

    ``date_sub`` would return a DATE and drop the time of day.
    """
    return _lit_ts(as_of) - F.make_dt_interval(F.lit(int(days)))


def look_back(date_col: str | Column, as_of, days: int) -> Column:
    """F1 predicate: inclusive lower bound, no upper bound, NULL dates drop out."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return c >= cutoff(as_of, days)


def month_key(ts: str | Column) -> Column:
    """``TO_CHAR(d, 'YYYY-MM')``; calendar year, never week-year."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM")


def to_day(text: str | Column) -> Column:
    """``TO_DATE(s, 'YYYY-MM-DD')`` as a TIMESTAMP_NTZ at midnight."""
    c = F.lit(text) if isinstance(text, str) else text
    return F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd"))


def nz(c: Column) -> Column:
    """An Oracle ``||`` operand, where NULL concatenates as ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def oracle_num(c: Column) -> Column:
    """Number as Oracle prints it inside ``||``.

    Trailing zeros after the point go, then a bare point, then a leading
    ``0`` before the point (``0.50`` -> ``.5``, ``1000.00`` -> ``1000``,
    ``0.00`` -> ``0``).  NULL stays NULL (wrap in ``nz`` for concat).
    """
    s = c.cast("string")
    has_point = s.contains(".")
    trimmed = F.when(has_point, F.regexp_replace(F.regexp_replace(s, r"0+$", ""), r"\.$", "")
                     ).otherwise(s)
    return F.regexp_replace(F.regexp_replace(trimmed, r"^0\.", "."), r"^-0\.", "-.")


def one_decimal(x: Column) -> Column:
    """Text of ``x`` with one decimal, rounded half-even on the exact binary
    value (as Go's and C's ``%.1f`` do; Java's ``%.1f`` would round half-up)."""
    return F.call_function("format_number", x, F.lit("0.0"))


def pct_label(rate: Column) -> Column:
    """0 -> 'N/A', else one decimal and a percent sign."""
    return F.when(rate == 0, F.lit("N/A")).otherwise(F.concat(one_decimal(rate), F.lit("%")))


def mb(bytes_col: Column) -> Column:
    """Bytes -> MiB as double."""
    return bytes_col.cast("double") / F.lit(1024.0 * 1024.0)


def department_label(name: Column, location: Column) -> Column:
    """``name (location)`` for a present department, else ``unknown``."""
    return F.when(name.isNotNull(), F.format_string("%s (%s)", name, location)
                  ).otherwise(F.lit("unknown"))
