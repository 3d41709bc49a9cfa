"""Columns of vectors as flat numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    good = F.forall(vector, number) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def matrices(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their vectors, one pair per length of vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    found = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        found.append((rows, values[offsets[rows][:, None] + np.arange(size)[None, :]]))
    return found
