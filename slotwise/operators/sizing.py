"""Checks made before a plan is chosen: columns present, and sides small enough to broadcast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a broadcast side may hold on each executor.
BROADCAST_BYTES = 16 << 20


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the side's bytes.

    The side is computed once and kept (in memory, else on disk); what it then holds is its size. A
    larger side gets no hint: Spark then shuffles both sides, and adaptive execution splits the
    skewed partitions.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    held = kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(kept) if held <= max_bytes else kept


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows with a missing grouping key take part in no group."""
    return df.na.drop(subset=list(keys))
