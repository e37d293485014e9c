"""What the two vector operators share: valid rows and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(col: str = "embedding") -> Column:
    """Not NULL, not empty, every component finite, not all zero."""
    x = F.col(col).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & ~odd & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal-length lists as a matrix of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def in_blocks(df: DataFrame, key: Column, rows: int, total: int) -> tuple[Column, int]:
    """A block number for each row, so that a block has about ``rows`` of ``total`` rows."""
    n = max(1, -(-total // rows))
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int"), n
