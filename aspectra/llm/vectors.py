"""Helpers for tables of embedding vectors."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components that is not null, empty or zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(col: pa.Array) -> np.ndarray:
    """[n, dim] doubles of a list column whose rows all have the same length."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component is divided out first, so no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
