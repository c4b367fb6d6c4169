"""Python functions in Spark: the last resort, made safer.

Built-in expressions come first, then pandas functions over Arrow batches, and
row functions only where neither can say it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import all_of


def null_safe(fn: Callable) -> Callable:
    """Return None when any argument is None, instead of calling ``fn``."""

    @functools.wraps(fn)
    def guarded(*args):
        return None if any(a is None for a in args) else fn(*args)

    return guarded


def udf_null_audit(df: DataFrame, inputs: list[str], output: str) -> DataFrame:
    """One row: total rows, and rows whose inputs are all set but output is NULL.

    A function returning another type than it declared gives such rows
    silently.
    """
    present = all_of(F.col(c).isNotNull() for c in inputs)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(present & F.col(output).isNull()).alias("lost_count"),
    )


class GroupTooLargeError(ValueError):
    """A group exceeds what one task may hold."""


def apply_grouped(
    df: DataFrame, keys: list[str], fn: Callable, schema: str, max_group_rows: int = 1_000_000
) -> DataFrame:
    """``applyInPandas`` behind a check of the group sizes.

    A group is handed to one Python worker whole, so a larger one raises before
    any group is gathered.  What can be said by a state per group takes
    ``map_grouped``, at any size.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_group_rows)
    found = sizes.first()
    if found is not None:
        raise GroupTooLargeError(f"group {[found[k] for k in keys]} has {found['__n']} rows")
    return df.groupBy(*keys).applyInPandas(fn, schema)


#: Groups whose states a task holds before it hands them on, and parts in which a group's states meet first.
HELD_STATES, STATE_PARTS = 10_000, 64


def map_grouped(
    df: DataFrame,
    keys: list[str],
    partial: Callable[[pd.DataFrame], dict],
    combine: Callable[[pd.DataFrame], dict],
    apply: Callable[[pd.DataFrame], pd.DataFrame],
    state: str,
    schema: str,
) -> DataFrame:
    """Group-wise pandas for groups of any size, in three steps over bounded chunks.

    ``partial`` makes a state (a dict with the columns of ``state``) of some rows
    of one group, ``combine`` makes one of several states of a group, and
    ``apply`` gets rows of any groups with their group's whole state beside them
    and returns rows of ``schema``.  States are made where the rows are read;
    those of a group meet in ``STATE_PARTS`` parts first, so no task gets more
    than a few from each task before it.  Rows are never gathered by group.
    NULL keys are a group like any other.
    """
    group = "__group"
    told = df.withColumn(group, F.to_json(F.struct(*keys)))
    names = [field.name for field in T.StructType.fromDDL(state)]
    held_schema = T.StructType([T.StructField(group, T.StringType()), *T.StructType.fromDDL(state)])

    def each(frame: pd.DataFrame, make: Callable[[pd.DataFrame], dict]) -> pd.DataFrame:
        rows = [{group: key, **make(part)} for key, part in frame.groupby(group, sort=False)]
        return pd.DataFrame(rows, columns=[group, *names])

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            made = each(batch, partial)
            held = made if held is None else each(pd.concat([held, made]), combine)
            if len(held) > HELD_STATES:
                yield held
                held = None
        if held is not None:
            yield held

    def combined(frame: pd.DataFrame) -> pd.DataFrame:
        return each(frame, combine)

    def applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield apply(batch)

    states = told.mapInPandas(partials, held_schema)
    part = F.pmod(F.spark_partition_id(), F.lit(STATE_PARTS))
    states = states.groupBy(group, part.alias("__part")).applyInPandas(combined, held_schema)
    whole = states.groupBy(group).applyInPandas(combined, held_schema)
    # A hot group's rows are split by the planner, as its side of the join is skewed.
    return told.join(whole, group).drop(group).mapInPandas(applied, schema)
