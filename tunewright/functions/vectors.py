"""Vector functions over ``array<float|double>`` columns.

Dense arithmetic runs in Arrow batches: the values of a batch are one flat buffer, so numpy works
on the whole batch without a loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-8  # fixed value: keeps a zero norm from dividing by zero


def to_matrix(values: pa.Array, kind: type = np.float64) -> np.ndarray:
    """An Arrow list array without nulls as an (n, dim) matrix."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        raise ValueError("a vector column holds nulls")
    n = len(values)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    if n == 0:
        return np.zeros((0, 0), kind)
    if flat.size % n:
        raise ValueError("vectors of one column must have one length")
    return flat.reshape(n, flat.size // n)


def row_slices(*lists: pa.Array, items: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of list arrays side by side with at most ``items`` values; a row stays whole."""
    ends = sum(a.value_lengths().fill_null(0).to_numpy().astype(np.int64) for a in lists).cumsum()
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + items, side="right")))
        yield at, upto - at
        at = upto


def from_matrix(m: np.ndarray) -> pa.Array:
    n, dim = m.shape if m.size else (m.shape[0], 0)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).reshape(-1)))


def unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True)) if m.size else np.ones((m.shape[0], 1))
    norms[norms == 0] = 1.0
    return m / norms


def normalize(c: Column) -> Column:
    """Scale to length one; a zero vector stays as it is."""

    @F.arrow_udf("array<double>")
    def scale(v: pa.Array) -> pa.Array:
        return from_matrix(unit_rows(to_matrix(v)))

    return scale(c)


def _rowwise(kind: str):
    @F.arrow_udf("double")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = to_matrix(a), to_matrix(b)
        dot = (x * y).sum(axis=1) if x.size else np.zeros(len(a))
        if kind == "dot":
            return pa.array(dot)
        nx, ny = (np.sqrt((m * m).sum(axis=1)) if m.size else np.zeros(len(a)) for m in (x, y))
        if kind == "soft":
            return pa.array(dot / (nx * ny + EPSILON))
        nx[nx == 0] = 1.0
        ny[ny == 0] = 1.0
        return pa.array(dot / (nx * ny))

    return run


def dot(a: Column, b: Column) -> Column:
    return _rowwise("dot")(a, b)


def cosine(a: Column, b: Column) -> Column:
    """Cosine; zero if either vector is zero."""
    return _rowwise("cosine")(a, b)


def soft_cosine(a: Column, b: Column) -> Column:
    """``a.b / (|a||b| + 1e-8)``."""
    return _rowwise("soft")(a, b)


def max_cosine(c: Column, anchors: np.ndarray) -> Column:
    """Largest cosine to the rows of a small constant matrix."""
    unit = unit_rows(np.asarray(anchors, dtype=np.float64))

    @F.arrow_udf("double")
    def score(v: pa.Array) -> pa.Array:
        x = unit_rows(to_matrix(v))
        return pa.array((x @ unit.T).max(axis=1) if x.size else np.zeros(len(v)))

    return score(c)
