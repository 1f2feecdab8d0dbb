"""Vectors of a table as whole numbers: what the two operators on embeddings share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries beyond count as this large, so that whole numbers keep within a long.
LARGEST = float(1 << 30)


def _kept(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite entries."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole_vectors(rows: DataFrame, scale: int, offset: int = 0, column: str = "embedding") -> tuple[DataFrame, int]:
    """``rows`` without vectors that are null or hold null or non-finite entries, with the
    others as ``x``: floor(scale * entry) + offset; and the number of their entries.

    A table has vectors of one length: the one that most rows have, the longer
    of two that tie. Rows of other lengths, and of none, are dropped. Entries
    beyond +-``LARGEST`` count as that.
    """
    vector = F.col(column).cast("array<double>")
    rows = rows.withColumn("x", vector).drop(*[c for c in (column,) if c != "x"]).where(_kept(F.col("x")))
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n")).where("length > 0")
    most = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()  # one row
    width = most[0].length if most else 0
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)) * scale) + F.lit(offset).cast("long"))
    return rows.where(F.size("x") == width).withColumn("x", whole), width


def matrix(column, width: int) -> np.ndarray:
    """The lists of an Arrow column as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def squares(rows: np.ndarray) -> list[int] | np.ndarray:
    """Sum of the squares of each row of whole numbers, exactly."""
    if not rows.size:
        return np.zeros(len(rows), dtype=np.int64)
    if rows.dtype != object and rows.shape[1] * float(np.abs(rows).max()) ** 2 < 1 << 62:
        return (rows * rows).sum(axis=1)
    rows = rows.astype(object)
    return (rows * rows).sum(axis=1)


def as_long(values) -> list[int | None]:
    """Whole numbers as longs; null for those that a long cannot hold."""
    return [int(v) if -(1 << 63) <= v < 1 << 63 else None for v in values]
