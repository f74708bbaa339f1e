"""Join sides broadcast behind a check of their size in bytes.

Most joins of the library are written plainly: Catalyst broadcasts a side whose
estimate is small, and adaptive execution one whose measured bytes are.
``bounded_broadcast`` is for a side that is already materialised (a checkpoint)
and cheap to count.  ``key_filtered`` is for a large side of which few rows have a
key on the other side, where that side's estimate is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIB = 1024 * 1024
DEFAULT_MAX_BROADCAST_BYTES = 64 * MIB

# Of a hashed row besides its fields, and of one fixed-width field.
ROW_BYTES, FIELD_BYTES = 24, 8
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def row_bytes(schema: T.StructType) -> int:
    """Bytes a hashed row of fixed-width fields takes; other types have no such bound."""
    odd = [f.name for f in schema.fields if not isinstance(f.dataType, _FIXED)]
    if odd:
        raise ValueError(f"no bound on the width of {odd}")
    wide = sum(isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18 for f in schema.fields)
    return ROW_BYTES + FIELD_BYTES * (len(schema.fields) + 2 * wide)


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows take at most ``max_bytes``, else ``df`` as it is (a shuffle join).

    Counts the rows: one job, one number to the driver.
    """
    return F.broadcast(df) if df.count() * row_bytes(df.schema) <= max_bytes else df


#: Rows that a byte of Catalyst's estimate may stand for, as columnar files pack a column's equal values.
ROWS_PER_BYTE = 8


def estimated_rows(df: DataFrame) -> int:
    """Rows ``df`` may have by Catalyst's estimate of its bytes (file sizes and row widths); runs no job."""
    return ROWS_PER_BYTE * int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


#: Bits that the keys of a ``key_filtered`` join are hashed to: its broadcast has a row for 64 of them, 2 ** 20 rows at most.
FILTER_BITS = 1 << 26


def key_filtered(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys``, for a join of the two to follow; runs no job.

    A semi join that Catalyst does not plan as a broadcast shuffles both sides whole, as its estimate knows
    nothing of how few keys a filter leaves.  Here the keys' hashes set bits of a table of bounded size, and rows whose bit
    is not set are dropped where they are read.  More keys let more rows pass, never fewer.  Where the estimate of ``keys``
    is small enough for a broadcast, equal keys may differ in their hash (other types), or the session has turned
    broadcasts off (a threshold below 0), ``rows`` stay as they are.
    """
    threshold = int(keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    kinds = {rows.schema[key].dataType, keys.schema[key].dataType}
    if threshold < 0 or len(kinds) > 1 or not isinstance(kinds.pop(), (T.IntegralType, T.DateType)):
        return rows
    if int(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= threshold:
        return rows
    def bit(df: DataFrame) -> Column:
        return F.pmod(F.xxhash64(df[key]), F.lit(FILTER_BITS))

    of = keys.select(F.shiftright(bit(keys), 6).alias("__word"), F.pmod(bit(keys), F.lit(64)).cast("int").alias("__bit"))
    words = of.groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    is_set = F.bit_get("__bits", F.pmod(bit(rows), F.lit(64)).cast("int")) == 1
    return rows.join(F.broadcast(words), (F.shiftright(bit(rows), 6) == F.col("__word")) & is_set, "left_semi")
