"""Partition layout and reuse of shared branches."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even round-robin partitions."""
    return df.repartition(partitions)


def co_locate(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Hash partitions by key: one shuffle serves all following steps on ``keys``."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER):
    """Keep a branch that several actions read, and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
