"""Writers: explicit modes, controlled file counts, retry-safe slices."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("overwrite", "append", "errorifexists", "ignore")


def write(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    files: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a table.  ``files`` asks for that many output files (per partition value at most)."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if files:
        df = df.repartition(files)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


class OutsideSliceError(ValueError):
    """A row does not belong to the slice being replaced."""


#: Characters Spark writes as %XX in partition folder names (fixed format).
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


#: Folder of the slice without a value (fixed name).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def slice_folder(path: str, column: str, value) -> str:
    """Folder holding one partition value, given as Spark writes it; None is the slice of NULLs."""
    text = NO_VALUE if value is None else "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(value))
    return f"{path.rstrip('/')}/{column}={text}"


def write_slice(df: DataFrame, path: str, column: str, value, partition_by: list[str] | None = None) -> None:
    """Make ``df`` the whole content of one partition, whatever it held before.

    The folder itself is overwritten, so an empty frame empties the slice and
    a repeated run leaves the same rows.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(slice_folder(path, column, value))


def _as_written(df: DataFrame, column: str, values: list) -> list[str | None]:
    """The values in the column's type, as Spark writes them into folder names."""
    kind = df.schema[column].dataType
    typed = [F.lit(v).try_cast(kind).cast("string").alias(f"v{i}") for i, v in enumerate(values)]
    found = list(df.sparkSession.range(1).select(*typed).first()) if values else []
    lost = [v for v, text in zip(values, found) if v is not None and text is None]
    if lost:
        raise ValueError(f"{lost} cannot be read as {kind.simpleString()}, the type of {column}")
    return found


def replace_slice(df: DataFrame, path: str, column: str, values: list) -> None:
    """Replace exactly the named slices of a partitioned table; safe to repeat.

    Every row must lie in ``values``, which may be given in the column's type or
    as text; None names the slice of NULLs.  One dynamic overwrite replaces all
    slices that receive rows; it would leave the others as they are, so slices
    that come out empty are emptied one by one.
    """
    wanted = set(_as_written(df, column, values))
    text = F.col(column).cast("string")
    known = text.isin([v for v in wanted if v is not None])
    inside = F.when(text.isNull(), F.lit(None in wanted)).otherwise(known)
    # At most len(values) + 1 rows come back.
    counts = {
        (r["inside"], r["text"]): r["n"]
        for r in df.groupBy(inside.alias("inside"), F.when(inside, text).alias("text")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    outside = sum(n for (ok, _), n in counts.items() if not ok)
    if outside:
        raise OutsideSliceError(f"{outside} row(s) outside {column} in {values}")
    if counts:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(path)
        )
    for value in wanted - {text for _, text in counts}:
        write_slice(df.filter(F.lit(False)).drop(column), path, column, value)


def compact(
    spark: SparkSession, src: str, dst: str, target_mb: int = 256, partition_by: list[str] | None = None
) -> int:
    """Rewrite many small files into few larger ones in a new folder.

    Rows do not change and the source stays.  Returns the number of files
    asked for.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(src)
    )
    # Only the file listing is read: the content column is pruned.
    size = listing.agg(F.sum("length")).first()[0] or 0
    files = max(1, math.ceil(size / (target_mb * 1024 * 1024)))
    # Coalescing merges neighbouring splits without a shuffle.
    writer = spark.read.parquet(src).coalesce(files).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(dst)
    return files
