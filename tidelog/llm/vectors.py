"""Vectors of floating-point numbers as vectors of integers, for tasks over Arrow batches.

A vector takes part if it is not null or empty and each component is there, finite, and
below 2**128 in size, which every 32-bit number is. All vectors have one number of components:
that of the vector with the smallest id. Others take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 2.0**128


def usable(vector: str) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def prepared(df: DataFrame, id_column: str, vector: str, **more: Column) -> tuple[DataFrame, int, int]:
    """``id, vector`` (and more) of the vectors that take part, their components, and their number."""
    rows = df.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        *[c.alias(name) for name, c in more.items()],
    ).where(usable("vector"))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.col("least").asc_nulls_last(), "size").first()
    if first is None:
        return rows, 0, 0
    return rows.where(F.size("vector") == first["size"]), first["size"], first["n"]


def floors(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` for each component: integers, exact as 64-bit floating-point numbers."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size) * float(scale))


def whole(values: np.ndarray, bits: float) -> np.ndarray:
    """Integers that were exact floating-point numbers: 64 bits where ``bits`` fit, else Python's."""
    if bits < 63:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], dtype=object).reshape(values.shape)


def bits(values: np.ndarray) -> float:
    """How many bits the largest magnitude takes."""
    return float(np.log2(max(1.0, np.abs(values).max(initial=0.0)) + 1))
