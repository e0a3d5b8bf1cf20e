"""Shuffle sizing and caching helpers for callers that want to set them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

# Sizing rule for shuffles, and the storage levels on offer.
BYTES_PER_ROW = 100
PARTITION_BYTES = 128 * 1024 * 1024
STORAGE_LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "MEMORY_AND_DISK_2": StorageLevel.MEMORY_AND_DISK_2,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
}


def shuffle_partitions(rows: int) -> int:
    """Shuffle partitions of about 128 MB for a number of transaction rows."""
    return max(1, -(-rows * BYTES_PER_ROW // PARTITION_BYTES))


def storage_level(name: str = "MEMORY_AND_DISK") -> StorageLevel:
    return STORAGE_LEVELS.get(name, StorageLevel.MEMORY_AND_DISK)


@contextmanager
def cached(df: DataFrame, level: str = "MEMORY_AND_DISK") -> Iterator[DataFrame]:
    """Keep a table in the executors while the block runs, and only that table."""
    kept = df.persist(storage_level(level))
    try:
        yield kept
    finally:
        kept.unpersist()
