"""Whole-number vectors: usable rows, quantising, and blocks of rows as bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(x: Column) -> Column:
    """Whether an array column is there and holds neither null nor non-finite components."""
    return x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def quantised(x: Column, scale: float) -> Column:
    """floor(scale * component) of every component, as whole numbers (beyond 64 bits: the ends of their range)."""
    return F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of whole numbers as a matrix, shorter vectors filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy()[column.offsets[0].as_py():column.offsets[len(column)].as_py()]
    if (sizes == dim).all():
        return flat.reshape(-1, dim).astype(np.int64)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def largest(data: np.ndarray) -> int:
    """The largest size of a component, exact for every 64-bit number."""
    return max(int(data.max(initial=0)), -int(data.min(initial=0)))


def to_bytes(data: np.ndarray) -> bytes:
    """A whole-number matrix in the least of 16, 32 and 64 bits that holds it."""
    most = largest(data)
    return data.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def from_bytes(raw: bytes, rows: int, dim: int) -> np.ndarray:
    """The matrix of ``rows`` rows that ``to_bytes`` wrote."""
    width = len(raw) // max(1, rows * dim)
    return np.frombuffer(raw, f"<i{width or 8}").reshape(rows, dim).astype(np.int64)
