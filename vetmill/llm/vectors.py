"""Shared steps of the operators on embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector has only finite components and not all are zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def keyed(table: DataFrame) -> DataFrame:
    """vec_id (long), embedding, usable, and h1, h2: 128 bits that equal vectors share."""
    v = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return v.select("vec_id", "embedding", (usable(F.col("embedding")) & F.col("vec_id").isNotNull()).alias("usable"),
                    F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))


def usual_size(valid: DataFrame) -> int:
    """The most frequent number of components (the smaller of two as frequent); 0 without rows."""
    first = valid.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return first[0] if first else 0


def sample(valid: DataFrame, total: int, most: int, by: str) -> DataFrame:
    """About `most` rows, at most twice that, picked by a hash of `by`; all rows of a small table."""
    share = max(1, total // most)
    return valid.where(F.pmod(F.xxhash64(F.lit(7), by), F.lit(share)) == 0).limit(2 * most)


def matrix(column):
    """An Arrow list column of doubles of one size as a matrix."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False) if len(column) else np.empty(0)
    return np.ascontiguousarray(flat.reshape(len(column), -1) if len(column) else np.empty((0, 0)), dtype=np.float64)
