"""Helpers shared by the operators that add columns to documents."""

from __future__ import annotations

import contextlib
import ctypes

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "__llm_result"


def per_row(df: DataFrame, result: Column, fields: list[str], keep: list[str] | None) -> DataFrame:
    """Select ``keep`` (all input columns when None) plus the fields of a struct result.

    A kept column whose name clashes with a result field (letter case aside)
    gives way to the result.
    """
    names = {f.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    return (df.select(*[F.col(f"`{c}`") for c in kept], result.alias(RESULT))
            .select(*[F.col(f"`{c}`") for c in kept], *[F.col(RESULT)[f].alias(f) for f in fields]))


def texts(values: pa.Array) -> list[str]:
    """Python strings of an Arrow array; null reads as empty."""
    return [x or "" for x in values.to_pylist()]


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than rows) of an Arrow string array; null reads as empty."""
    values = values.fill_null("").cast(pa.large_string())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int):
    """Row ranges whose texts hold about ``limit`` bytes; a longer text is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def text_blocks(values: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of about ``limit`` bytes with their ``texts``, made one range after another: a batch's texts never stand together."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    for a, b in row_blocks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), limit):
        yield a, b, texts(values.slice(a, b - a))


def release() -> None:
    """Gives freed memory back to the system: workers live on between stages, and so would their largest heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)
