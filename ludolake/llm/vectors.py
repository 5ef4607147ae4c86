"""Vector columns as numpy matrices, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors with entries, of which none is null, NaN or infinite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def numeric(df: DataFrame, vector: str) -> Column:
    """The vector column; entries that are no floats become doubles."""
    column = F.col(f"`{vector}`")
    kind = df.schema[vector].dataType.simpleString()
    return column if kind in ("array<float>", "array<double>") else column.cast("array<double>")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column without nulls as a matrix of doubles; all vectors must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if sizes.min() != sizes.max():
        raise ValueError(f"vectors of different lengths: {sizes.min()} and {sizes.max()}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def floors(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * value) as whole doubles without a negative zero; beyond 2^53 they would not be exact."""
    out = np.floor(scale * values) + 0.0
    if out.size and not np.abs(out).max() < 2.0 ** 53:
        raise OverflowError("an entry is too large for exact whole numbers")
    return out
