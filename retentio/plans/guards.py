"""Broadcast only what has a proven size bound.

Tables whose size is fixed by construction (countries, currencies x months,
rule sheets, tax sheet, zone sheet) are hinted directly. Tables that come from
storage and could grow are checked first: ``limit(n + 1).count()`` reads at most
n + 1 rows per partition, so the check stays cheap even on a large input. Above
the bound the frame is returned unhinted and Spark/AQE pick a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we are willing to ship to every executor.
MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Hint a frame whose row count is bounded by construction (not by data)."""
    return F.broadcast(df)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
