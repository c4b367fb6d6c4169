"""Join operators beyond a plain ``DataFrame.join``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, same


def broadcast_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only if the frame has at most ``max_rows`` rows.

    Reads no more than ``max_rows + 1`` rows to find out; a larger frame comes
    back without a hint and is joined by shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join where a NULL key equals a NULL key; keys come out once."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in on})
    joined = left.join(renamed, all_of(same(F.col(k), F.col(f"__r_{k}")) for k in on), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("right", "full"):
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in on})
    return joined.drop(*[f"__r_{k}" for k in on])


def orphans(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """Child rows without a parent; a NULL key is an orphan too."""
    return child.join(parent.select(*on).distinct(), on, "left_anti")


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    time: str,
    start: str = "effective_start",
    end: str = "effective_end",
    how: str = "left",
) -> DataFrame:
    """Attach the dimension version valid when the fact happened.

    Intervals are half-open, ``[start, end)``, and a NULL end is open.  The key
    equality drives the join (hash or sort-merge, split by AQE when a fact key
    is hot) and the interval is a residual condition, so overlapping versions
    show up as several rows.  For keys with very many versions use
    ``windows.asof_versions``.
    """
    if how not in ("inner", "left"):
        raise ValueError("a point-in-time join is inner or left")
    versions = dim.withColumnsRenamed({k: f"__d_{k}" for k in on})
    condition = all_of(F.col(k) == F.col(f"__d_{k}") for k in on)
    condition &= F.col(time) >= F.col(start)
    condition &= F.col(end).isNull() | (F.col(time) < F.col(end))
    return fact.join(versions, condition, how).drop(*[f"__d_{k}" for k in on])


def range_join(
    points: DataFrame, ranges: DataFrame, point: Column, low: str, high: str, width: float, how: str = "inner"
) -> DataFrame:
    """Match each point with the ranges ``low <= point < high`` holding it.

    A range condition alone would compare every pair.  Ranges go to grids of
    cells twice as wide from level to level, each to the first level whose
    cells are as long as it is: there it touches two cells at most.  A point is
    looked up in its own cell of every level in use.  ``width`` is the cell
    width of the first level, a guess at the length of short ranges.
    """
    if how not in ("inner", "left"):
        raise ValueError("a range join is inner or left")

    def cell(value: Column, level: Column) -> Column:
        return F.floor(value / (F.lit(float(width)) * F.pow(F.lit(2.0), level))).cast("bigint")

    length = (F.col(high) - F.col(low)).cast("double")
    level = F.greatest(F.ceil(F.log2(length / F.lit(float(width)))), F.lit(0)).cast("int")
    levelled = ranges.filter(F.col(low) < F.col(high)).withColumn("__range_level", level)
    first, last = (cell(F.col(c), F.col("__range_level")) for c in (low, high))
    listed = levelled.withColumn("__range_cell", F.explode(F.sequence(first, last)))
    # A few dozen numbers at most, as lengths are numbers.
    levels = levelled.agg(F.sort_array(F.collect_set("__range_level"))).scalar()
    placed = points.withColumn("__point", point)
    if how == "left":
        placed = placed.withColumn("__row", F.monotonically_increasing_id())
    spread = placed.withColumn("__level", F.explode_outer(levels))
    condition = (
        (F.col("__level") == F.col("__range_level"))
        & (cell(F.col("__point"), F.col("__level")) == F.col("__range_cell"))
        & (F.col("__point") >= F.col(low))
        & (F.col("__point") < F.col(high))
    )
    joined = spread.join(listed, condition, how)
    if how == "left":
        # Of the levels without a match only the first stays, and only if no level has one.
        hit = F.col("__range_cell").isNotNull()
        kept = Window.partitionBy("__row")
        joined = joined.withColumn("__hits", F.count_if(hit).over(kept))
        lowest = F.coalesce(F.col("__level") == F.get(levels, F.lit(0)), F.lit(True))
        joined = joined.filter(hit | ((F.col("__hits") == 0) & lowest))
    return joined.drop("__level", "__range_level", "__range_cell", "__point", "__row", "__hits")
