"""Vectors as numpy rows, and which of them take part in comparisons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    plain = vector.cast("array<double>")
    return F.coalesce(
        F.forall(plain, finite) & F.exists(plain, lambda x: x != 0) & (F.size(plain) > 0), F.lit(False)
    )


def most_common_size(vectors: DataFrame, column: str) -> int:
    """The length that most vectors have (the smaller of two); 0 without vectors."""
    found = vectors.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.n if found else 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(-1, size)


def sampled(df: DataFrame, key: str, rows: int, most: int, seed: int) -> DataFrame:
    """About ``most`` of ``rows`` rows, the same ones on every run."""
    rate = min(1.0, most / max(rows, 1))
    return df.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30)))
