"""Distinct counts from stored sketches.

A sketch of one slice (a day, say) has a fixed size whatever the slice holds,
and sketches of several slices merge into that of all their rows.  Kept as a
table, they give distinct counts over any set of slices without reading the
rows again, and a new or corrected slice is one small write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_col
from tidemark.sources.sinks import replace_slice, write

SKETCH = "sketch"
#: A sketch has at most 2 ** LOG_SIZE registers of a byte.
LOG_SIZE = 14


def error_bound(deviations: float = 3.0) -> float:
    """Relative error that an estimate exceeds once in several hundred times (three standard deviations)."""
    return deviations * 1.04 / 2 ** (LOG_SIZE / 2)


def slice_sketches(df: DataFrame, by: list[str], value: Column | str) -> DataFrame:
    """One row per slice: its sketch of ``value``, combined map-side.  NULL values do not count."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(as_col(value), LOG_SIZE).alias(SKETCH))


def store_sketches(df: DataFrame, path: str, by: list[str], value: Column | str) -> None:
    """Write the sketches of all slices; the first column of ``by`` is the unit that is replaced later."""
    write(slice_sketches(df, by, value), path, partition_by=by[:1])


def replace_sketches(df: DataFrame, path: str, by: list[str], value: Column | str, slices: list) -> None:
    """Add or replace the named slices from their rows; a repeated run changes nothing."""
    replace_slice(slice_sketches(df, by, value), path, by[0], slices)


def distinct_from_sketches(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Estimated distinct values per group of slices (``by``), or over all of them; reads sketches only."""
    merged = F.hll_union_agg(SKETCH).alias(SKETCH)
    return spark.read.parquet(path).groupBy(*(by or [])).agg(merged).select(
        *(by or []), F.hll_sketch_estimate(SKETCH).alias("estimate")
    )
