"""Joins between data of any size and parameter tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 128


def broadcast_within(df: DataFrame, n_bytes: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the size is known and within ``limit``; else leave it to AQE."""
    if n_bytes is not None and n_bytes <= limit:
        return F.broadcast(df)
    return df


def join_spread(
    rows: DataFrame, units: DataFrame, key: str, how: str = "inner", bytes_per_key: int | None = None
) -> DataFrame:
    """Join of ``rows`` with ``units``, both too large to broadcast.

    Keys with more than 1/HOT_SHARE of the rows, at most HOT_SHARE of them, meet their units by a
    broadcast of those units alone, where ``bytes_per_key`` bounds its size (else adaptive execution
    chooses how to join them); all other rows are shuffled. Nothing runs before the result is
    read: the keys are a part of the plan, which reads ``rows`` once more for their counts.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = rows.agg(F.count(F.lit(1)).alias("_all")).scalar()
    hot = F.broadcast(counts.filter(F.col("_rows") * HOT_SHARE > total).select(key))
    hot_bytes = None if bytes_per_key is None else HOT_SHARE * bytes_per_key
    hot_units = broadcast_within(units.join(hot, key, "left_semi"), hot_bytes)
    spread = rows.join(hot, key, "left_semi").join(hot_units, key, how)
    return spread.unionByName(rows.join(hot, key, "left_anti").join(units, key, how))
