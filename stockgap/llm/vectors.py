"""Vector columns: which rows take part, and fast pseudo-rotations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sound(v: Column) -> Column:
    """Not null, not empty, every component present and finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def width(rows: DataFrame, v: str = "v") -> int:
    """The most frequent vector length (0 for no rows); others take no part."""
    got = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return int(got["d"]) if got else 0


def matrix(column, dim: int) -> np.ndarray:
    """float64 rows of a pandas column of arrays."""
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, dim))


def hadamard(y: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), orthonormal."""
    n, d = y.shape
    h = 1
    while h < d:
        z = y.reshape(n, d // (2 * h), 2, h)
        y = np.concatenate([z[:, :, :1] + z[:, :, 1:], z[:, :, :1] - z[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return y / np.sqrt(d)
