"""Streaming file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", max_files: int | None = None
) -> DataFrame:
    """Watch a folder.  A schema is required, and CSV files carry a header line."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream an existing Parquet table (a file or a folder of files)."""
    # The file source wants a folder or a pattern; ``[t]`` makes one of a plain name.
    pattern = f"{path[:-1]}[{path[-1]}]"
    return stream_files(spark, pattern, spark.read.parquet(path).schema, "parquet", max_files)
