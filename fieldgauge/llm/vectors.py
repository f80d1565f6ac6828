"""Vectors in Arrow and numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Neither NULL nor empty nor zero, all components present and finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles; a shorter vector is read as ending in zeros."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def units(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by the largest component first, so that no square over- or underflows."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))
