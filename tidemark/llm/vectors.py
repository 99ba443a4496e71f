"""Vector columns: which rows take part, and Arrow lists as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str | Column) -> Column:
    """True for a vector that is not null and holds no null and no component that is not finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(column.isNotNull() & good, F.lit(False))


def longest(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector; 0 for an empty table."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), width))
    if not len(column) or not width:
        return out
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[np.arange(width) < size[:, None]] = values
    return out
