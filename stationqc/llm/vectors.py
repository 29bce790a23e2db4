"""Vectors as whole numbers, packed for numpy kernels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit(dim: int) -> int:
    """Components are clipped to this size, so that inner products and squared distances fit 64 bits."""
    return 2 ** min(26, (60 - max(1, dim).bit_length()) // 2)


def whole_vectors(rows: DataFrame, vec_col: str, scale: int, out: str = "x") -> tuple[DataFrame, int]:
    """Rows whose vector is not null, holds only finite numbers and has the most frequent length.

    ``out`` is the vector floor(scale * component) as array<long>; the second result
    is its length, 0 for a table without such rows.
    """
    x = F.col(vec_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col(vec_col).isNotNull() & fine)
    top = rows.groupBy(F.size(vec_col).alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).first()
    dim = top["dim"] if top else 0
    most = float(limit(dim))
    clipped = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-most)), F.lit(most))))
    return rows.filter(F.size(vec_col) == dim).withColumn(out, clipped), dim


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """An Arrow column of equally long lists of integers as int64 rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as little-endian 32-bit integers (``limit`` fits)."""
    flat = np.ascontiguousarray(x, "<i4").reshape(len(x), -1)
    return [row.tobytes() for row in flat]


def unpacked(column, dim: int, kind: str = "<i4") -> np.ndarray:
    """The rows that ``packed`` wrote, from any sequence of bytes."""
    return np.frombuffer(b"".join(column), kind).reshape(-1, dim)


def exact_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a with those of b, exact for clipped components."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2 ** 53:                                        # every partial sum is exact in floating point
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T
