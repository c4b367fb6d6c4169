"""Set operations with guards against silent mislabelling."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by position, refused when the names do not line up."""
    first, *rest = frames
    for frame in rest:
        if frame.columns != first.columns:
            raise ValueError(f"columns differ in name or order: {first.columns} and {frame.columns}")
    for frame in rest:
        first = first.union(frame)
    return first


def union_by_name(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Union by name; with ``fill_missing`` absent columns become NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=fill_missing)
    return first
