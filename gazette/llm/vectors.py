"""Vectors of an Arrow list column as whole numbers, shared by the vector operators.

A vector takes part if it is not NULL and all its components are finite.  Each
component ``x`` becomes ``floor(scale * x)``, ``x`` read as double.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(vector: str) -> Column:
    """Whether a vector is not NULL and holds finite components only."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double"))
                   | (F.abs(c.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as long; components that no long holds are an error."""
    q = np.floor(values.astype(np.float64) * scale)
    if np.abs(q).max(initial=0) >= 1 << 31:
        raise OverflowError(f"component beyond {(1 << 31) // scale}: products of such vectors overflow a long")
    return q.astype(np.int64)


def by_length(column: pa.Array, scale: int, length: int | None = None):
    """``(rows, q)`` for each vector length of a batch: usable rows and their quantised vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    off = np.asarray(column.offsets)
    flat = column.values
    x = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
    ok = np.asarray(column.is_valid()) & (bad[off[1:]] == bad[off[:-1]])
    size = np.diff(off)
    for n in np.unique(size[ok]) if length is None else [length]:
        rows = np.flatnonzero(ok & (size == n))
        if len(rows):
            yield rows, quantised(x[off[rows, None] + np.arange(n)] if n else np.zeros((len(rows), 0)), scale)
