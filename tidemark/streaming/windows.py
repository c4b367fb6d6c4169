"""Event-time aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(
    df: DataFrame, time: str, size: str, delay: str, aggs: dict[str, Column], by: list[str] | None = None
) -> DataFrame:
    """Tumbling windows with a watermark.

    Rows later than ``delay`` behind the newest time seen are left out, and
    state older than that is released.  A time without zone is read in the
    session's zone, since a watermark needs an instant.
    """
    if dict(df.dtypes)[time] != "timestamp":
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, size), *(by or []))
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *(by or []), *aggs)
    )
