"""Vectors in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not null, not empty, every component finite, not all of them zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    v = F.col(column)
    return (v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, finite), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def matrices(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: the rows that have it, and their vectors as doubles."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    values = column.values.to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        out[int(d)] = rows, values[starts[rows][:, None] + np.arange(int(d))].astype(np.float64)
    return out


def blobs(m: np.ndarray) -> pa.Array:
    """One binary per row of ``m``."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(m)], pa.binary())


def stacked(column: pa.Array, dtype: str) -> np.ndarray:
    """Rows of equally long binaries as a matrix."""
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, -1)


def rows_of(df: DataFrame, id_column: str, vector: str, *more: str) -> DataFrame:
    return df.where(usable(vector) & F.col(id_column).isNotNull()).select(id_column, vector, *more)
