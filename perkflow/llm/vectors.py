"""Number vectors on their way from Arrow to numpy: which rows count, components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components are held within +-LIMIT, so sums of products stay exact in 64 bits.
LIMIT = 1 << 24


def usable(vector: str) -> Column:
    """Vectors that are there and hold neither a null nor a non-finite component."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def longest(rows: DataFrame, vector: str) -> int:
    """The length of the longest vector; 0 for an empty table."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def scaled(column: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of every component, one row of ``width`` per vector; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = np.asarray(column.offsets).astype(np.int64)
    values = np.asarray(column.values.cast(pa.float64()))[off[0] : off[-1]]
    size = np.diff(off)
    whole = np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64)
    if (size == width).all():
        return whole.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = whole
    return out


def number_type(peak: int, width: int) -> type:
    """float64 where sums of ``width`` products of numbers up to ``peak`` are exact in it, else int64."""
    return np.float64 if (2 * peak + 1) ** 2 * max(width, 1) < 2**53 else np.int64


def binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    flat = np.ascontiguousarray(rows)
    size = flat.shape[1] * flat.itemsize
    offsets = np.arange(len(flat) + 1, dtype=np.int64) * size
    return pa.Array.from_buffers(pa.large_binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).cast(pa.binary())


def rows_of(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """The matrix that ``binary`` made."""
    if len(column) == 0:
        return np.zeros((0, width), dtype)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]].copy().view(dtype).reshape(len(column), width) if width else np.zeros((len(column), 0), dtype)
