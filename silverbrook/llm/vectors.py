"""Columns of vectors: which rows hold one, and Arrow lists as matrices."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, infinite or not a number."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))


def usual_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length of the vectors, the shorter of two as frequent; 0 without a vector.  Runs a grouped count."""
    counts = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.orderBy(F.desc("n"), "length").first()
    return found["length"] if found else 0


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Lists of one length, without nulls, as the rows of a float64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def packed(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as the bytes of its numbers."""
    data, width = np.ascontiguousarray(rows).tobytes(), rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, len(data) + 1, width, dtype=np.int32).tobytes()), pa.py_buffer(data)])


def unpacked(column: pa.Array, kind: str, length: int) -> np.ndarray:
    """The matrix that :func:`packed` has written."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, length)
