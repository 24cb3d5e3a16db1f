"""Vectors of an embeddings table as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_usable(embedding: Column) -> Column:
    """Not null or empty, every component a finite number, not all of them zero."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(
        (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False)
    )


def common_size(usable: DataFrame) -> int:
    """The most frequent number of components (the smallest of several), 0 without vectors."""
    sizes = usable.groupBy(F.size("embedding").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A row of doubles for each list; all lists have `size` components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), size)


def scaled(x: np.ndarray, top: np.ndarray | None = None) -> np.ndarray:
    """Rows times a power of two that brings the largest component (or `top`) below one: squares
    neither overflow nor vanish, and no digit is lost to it."""
    if top is None:
        top = np.abs(x).max(axis=1, initial=0)[:, None]
    return np.ldexp(x, -np.frexp(top)[1])


def away_from(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row from the query, whatever the size of the components; infinite
    where it is more than a double holds."""
    with np.errstate(over="ignore"):
        apart = x - query
        top = np.abs(apart).max(axis=1, initial=0)
        near = np.sqrt((scaled(apart, np.where(np.isfinite(top), top, 1.0)[:, None]) ** 2).sum(axis=1))
        return np.where(np.isfinite(top), np.ldexp(near, np.frexp(top)[1]), np.inf)


def sampled(usable: DataFrame, key: str, most: int) -> DataFrame:
    """A sample of about `most` rows, never many more, the same for the same keys."""
    total = usable.count()
    if total <= most:
        return usable
    part = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30))
    return usable.filter(part < int(most / total * (1 << 30)))
