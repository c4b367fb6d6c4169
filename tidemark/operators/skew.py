"""Measuring and splitting skewed keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, as_col, same

SALT = "__salt"


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("row_count"))


def partition_balance(df: DataFrame) -> DataFrame:
    """One row: partitions in use, largest, median and largest / median."""
    return partition_profile(df).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.max("row_count").alias("largest"),
        F.median("row_count").alias("median"),
        F.try_divide(F.max("row_count"), F.median("row_count")).alias("ratio"),
    )


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, combined map-side before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def key_skew(df: DataFrame, keys: list[str], top: int = 20) -> DataFrame:
    """The hottest keys and their share of all rows."""
    counts = key_counts(df, keys)
    total = counts.agg(F.sum("row_count")).scalar()
    return (
        counts.orderBy(F.col("row_count").desc(), *[F.col(k).asc_nulls_first() for k in keys])
        .limit(top)
        .withColumn("share", F.col("row_count").cast("double") / total.cast("double"))
    )


def heavy_hashes(df: DataFrame, keys: list[str], share: float) -> tuple[dict[int, int], int]:
    """``xxhash64`` and estimated rows of every key holding more than ``share`` of all, and the row count.

    Counting every key would shuffle about as much as the job being planned.
    A frequent-items sketch per task needs a fixed few kilobytes and is merged
    in two steps, so that no task receives the sketches of all others.  Its
    error is kept well below ``share``: no hot key is missed, and at most
    ``2 / share`` hashes come back.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError("share must lie between 0.0001 and 1")
    tracked = min(1_000_000, math.ceil(32 / share))
    sketches = (
        df.select(F.xxhash64(*keys).alias("hash"), F.pmod(F.spark_partition_id(), F.lit(256)).alias("part"))
        .groupBy("part")
        .agg(F.expr(f"approx_top_k_accumulate(hash, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    )
    # Grouped, because merging no sketches at all is an error in Spark.
    merged = (
        sketches.groupBy(F.lit(1))
        .agg(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {math.ceil(2 / share)})").alias(
                "top"
            ),
            F.sum("n").alias("total"),
        )
        .first()
    )
    if merged is None:
        return {}, 0
    total = merged["total"]
    return {r["item"]: r["count"] for r in merged["top"] if r["count"] > 0.9 * share * total}, total


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys holding more than ``share`` of the rows, by exact count, as a local table.

    There can be at most ``1 / share`` of them, which is the size bound behind
    every broadcast of this result.  Only candidates are counted exactly, and
    they are combined map-side.
    """
    hashes, total = heavy_hashes(df, keys, share)
    counts = key_counts(df.filter(F.xxhash64(*keys).isin(list(hashes)) if hashes else F.lit(False)), keys)
    return settled(counts.filter(F.col("row_count") > share * total).select(*keys))


def settled(df: DataFrame) -> DataFrame:
    """Fetch a result of proven small size and hand it back as a local table.

    Plans built on it neither repeat the work behind it nor guess its size.
    """
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)


def mark_hot(df: DataFrame, hot: DataFrame, keys: list[str], flag: str = "__hot") -> DataFrame:
    """Add a boolean telling whether the row's key (NULL included) is in ``hot``."""
    marked = hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.lit(True).alias("__is"))
    on = all_of(same(F.col(k), F.col(f"__h_{k}")) for k in keys)
    return (
        df.join(F.broadcast(marked), on, "left")
        .withColumn(flag, F.coalesce(F.col("__is"), F.lit(False)))
        .drop("__is", *[f"__h_{k}" for k in keys])
    )


def salt_of(id_cols: list[str], salts: int) -> Column:
    """Salt from the row's own identity.

    A random salt would change when a lost task is run again; a hash does not.
    """
    return F.pmod(F.xxhash64(*id_cols), F.lit(salts)).cast("int")


def add_salt(df: DataFrame, id_cols: list[str], salts: int) -> DataFrame:
    return df.withColumn(SALT, salt_of(id_cols, salts))


def salted_agg(
    df: DataFrame,
    keys: list[str],
    id_cols: list[str],
    salts: int = 16,
    sums: dict[str, Column | str] | None = None,
    counts: dict[str, Column | str] | None = None,
    mins: dict[str, Column | str] | None = None,
    maxs: dict[str, Column | str] | None = None,
    avgs: dict[str, Column | str] | None = None,
) -> DataFrame:
    """Two-stage aggregate: by (key, salt), then by key.

    Only aggregates that merge exactly are offered; an average is a merged sum
    over a merged count.  Each dict maps an output name to its input.
    """
    sums, counts, mins, maxs, avgs = (dict(d or {}) for d in (sums, counts, mins, maxs, avgs))
    first = (
        [F.sum(as_col(c)).alias(n) for n, c in sums.items()]
        + [F.count(as_col(c)).alias(n) for n, c in counts.items()]
        + [F.min(as_col(c)).alias(n) for n, c in mins.items()]
        + [F.max(as_col(c)).alias(n) for n, c in maxs.items()]
        + [F.sum(as_col(c)).alias(f"__s_{n}") for n, c in avgs.items()]
        + [F.count(as_col(c)).alias(f"__c_{n}") for n, c in avgs.items()]
    )
    second = (
        [F.sum(n).alias(n) for n in sums]
        + [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts]
        + [F.min(n).alias(n) for n in mins]
        + [F.max(n).alias(n) for n in maxs]
        + [
            F.try_divide(F.sum(f"__s_{n}").cast("double"), F.sum(f"__c_{n}").cast("double")).alias(n)
            for n in avgs
        ]
    )
    return add_salt(df, id_cols, salts).groupBy(*keys, SALT).agg(*first).groupBy(*keys).agg(*second)


#: Most keys that get salts: every other key has fewer rows than any of these.
MOST_SALTED = 100_000


def salt_counts(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Keys with more than ``rows`` rows and the ``salts`` they need to have about that many per salt, as a local table.

    Counts are exact and combined map-side.  Only the ``MOST_SALTED`` largest
    keys are fetched, which bounds the table: what comes after them holds less
    than a hundred-thousandth of the rows each.
    """
    large = key_counts(df, keys).filter(F.col("row_count") > rows)
    ordered = large.orderBy(F.col("row_count").desc()).limit(MOST_SALTED)
    return settled(ordered.select(*keys, F.ceil(F.col("row_count") / rows).cast("int").alias("salts")))


def _with_salts(df: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``__salts``: how many salts the row's key (NULL included) has, 1 for all keys not listed."""
    marked = counts.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.col("salts").alias("__salts"))
    on = all_of(same(F.col(k), F.col(f"__h_{k}")) for k in keys)
    joined = df.join(F.broadcast(marked), on, "left").drop(*[f"__h_{k}" for k in keys])
    return joined.withColumn("__salts", F.coalesce("__salts", F.lit(1)))


def salted_parts(
    big: DataFrame, small: DataFrame, on: list[str], id_cols: list[str], rows: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a salted join with their ``SALT``: rows of a large key spread, its partners repeated."""
    counts = salt_counts(big, on, rows)
    spread = F.pmod(F.xxhash64(*id_cols), F.col("__salts")).cast("int")
    left = _with_salts(big, counts, on).withColumn(SALT, spread).drop("__salts")
    repeated = F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))
    return left, _with_salts(small, counts, on).withColumn(SALT, repeated).drop("__salts")


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], id_cols: list[str], rows: int = 1_000_000, how: str = "inner"
) -> DataFrame:
    """Join with the large keys of the big side spread over as many sub-keys as they need.

    A key with more than ``rows`` rows gets one salt per ``rows`` of them, from
    exact counts, and only its partners on the small side are repeated.  All
    other keys, and their partners, stay as they are.  ``id_cols`` identify a row
    of the big side.  Right and full joins are refused, since a repeated
    unmatched row would come out several times.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join cannot be salted")
    left, right = salted_parts(big, small, on, id_cols, rows)
    return left.join(right, [*on, SALT], how).drop(SALT)
