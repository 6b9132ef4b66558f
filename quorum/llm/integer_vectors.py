"""Vectors of integers: exact components, exact squared distances, small sums.

Shared by the operators that quantise embeddings before they compare them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, v array<bigint>, *carry)``: each component x as floor(1024 * x) in double precision.

    Rows whose vector is null or holds a null or non-finite component are dropped.  A squared
    distance has to fit 64 bits, so a component whose integer could break that (beyond 2^27 at
    64 components) fails the job with a message instead of wrapping around.
    """
    base = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"),
                     *(F.col(c) for c in carry))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    most = F.floor(F.sqrt(F.lit(2.0 ** 61) / F.greatest(F.size("x"), F.lit(1))))
    # Filters on v may run before the one below, so odd components do not raise.
    scaled = F.transform("x", lambda x: F.when(odd(x), F.lit(None).cast("long"))
                         .when(F.abs(x * SCALE) <= most, F.floor(x * SCALE))
                         .otherwise(F.raise_error(F.lit("a component is too large for distances of 64 bits")).cast("long")))
    return base.filter(F.col("x").isNotNull() & ~F.exists("x", odd)).select("id", scaled.alias("v"), *carry)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column whose rows all hold ``width`` values, as a matrix of 64-bit integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def lists(rows: np.ndarray, type_: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)).cast(type_))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All exact squared distances of the rows of ``a`` to the rows of ``b``.

    Products go through double precision only where every partial sum is an exact integer.
    """
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = max(int(np.abs(a).max()), int(np.abs(b).max()))
    if 4 * most * most * a.shape[1] < 2 ** 52:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)


def squared_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of row i of ``a`` to row i of ``b``."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def floor_mean(sums: Iterable[int], count: int) -> list[int]:
    return [int(s) // count for s in sums]


def joined(values: Iterable[int]) -> str:
    return ",".join(str(int(v)) for v in values)


def digest(values: Iterable[int]) -> str:
    """Lower-case hex SHA-256 of decimal integers joined by commas."""
    return hashlib.sha256(joined(values).encode()).hexdigest()

