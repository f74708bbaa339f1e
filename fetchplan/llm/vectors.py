"""Rows of embeddings as numpy arrays, and which of them take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(vec: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold finite components only."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def lengths(rows: DataFrame, vec: str) -> list[int]:
    """Lengths that at least two of the valid vectors have: only such can meet another."""
    return sorted(r["d"] for r in rows.groupBy(F.size(vec).alias("d")).count().where("count > 1").collect())


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of an Arrow list column of length ``d`` as float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by a power of two first keeps squares finite."""
    if not len(x):
        return x
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision; equal rows give equal values wherever they stand."""
    def scaled(z):
        return np.ldexp(z, -np.frexp(np.abs(z).max(axis=1, keepdims=True))[1])

    x, y = scaled(np.ascontiguousarray(x)), scaled(np.ascontiguousarray(y))
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
