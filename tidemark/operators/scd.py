"""Slowly changing dimensions with full history (type 2).

A dimension has its keys and attributes plus ``effective_start`` (date),
``effective_end`` (date, NULL while open) and ``is_current``; intervals are
half-open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, any_of, same
from tidemark.operators.tables import require_unique
from tidemark.operators.windows import lag_lead

START, END, CURRENT = "effective_start", "effective_end", "is_current"


def is_open() -> Column:
    """Whether a version is the current one; where ``is_current`` is NULL, an open end tells."""
    return F.coalesce(F.col(CURRENT), F.col(END).isNull())


def _differs(tracked: list[str], prefix: str) -> Column:
    return any_of(~same(F.col(c), F.col(f"{prefix}{c}")) for c in tracked)


def scd2_changes(dim: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Incoming rows whose tracked attributes differ from the current version.

    The comparison is null-safe, so a value appearing or vanishing counts.
    """
    now = dim.filter(is_open()).select(
        *[F.col(k).alias(f"__c_{k}") for k in keys], *[F.col(c).alias(f"__c_{c}") for c in tracked]
    )
    on = all_of(F.col(k) == F.col(f"__c_{k}") for k in keys)
    return incoming.join(now, on).filter(_differs(tracked, "__c_")).select(*incoming.columns)


def scd2_apply(dim: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str], effective) -> DataFrame:
    """The whole next dimension: expired, changed, new and untouched rows.

    One plan gives the complete next state, so a rerun changes nothing and no
    moment exists without a current row.  A change dated on or before the
    start of the version it replaces fails the job; incoming rows without a key
    are refused, as a rerun could not recognise them.
    """
    require_unique(incoming, keys, nulls=False)
    when = F.lit(effective).cast("date")
    other = [c for c in dim.columns if c not in (*keys, START, END, CURRENT)]
    source = incoming.select(
        *[F.col(k).alias(f"__i_{k}") for k in keys],
        *[F.col(c).alias(f"__i_{c}") for c in other],
        F.lit(True).alias("__hit"),
    )
    on = all_of(F.col(k) == F.col(f"__i_{k}") for k in keys)
    # Closed versions cannot change and skip the join.
    closed = dim.filter(~is_open())
    open_rows = dim.filter(is_open()).join(source, on, "left")
    changed = F.coalesce(F.col("__hit"), F.lit(False)) & _differs(tracked, "__i_")
    checked = F.when(F.col(START) < when, when).otherwise(
        F.raise_error(F.concat(F.lit("change is not later than the version starting "), F.col(START).cast("string")))
    )
    # Each open row yields itself, closed if it changed, and then its successor.
    old = F.struct(
        *[F.col(c) for c in (*keys, *other)],
        F.col(START),
        F.when(changed, checked).otherwise(F.col(END)).alias(END),
        (~changed).alias(CURRENT),
    )
    new = F.struct(
        *[F.col(k) for k in keys],
        *[F.col(f"__i_{c}").alias(c) for c in other],
        when.alias(START),
        F.lit(None).cast("date").alias(END),
        F.lit(True).alias(CURRENT),
    )
    versions = F.when(changed, F.array(old, new)).otherwise(F.array(old))
    renewed = open_rows.select(F.inline(versions)).select(*dim.columns)
    unseen = incoming.join(dim.filter(is_open()).select(*keys).distinct(), keys, "left_anti").select(
        *keys, *other, when.alias(START), F.lit(None).cast("date").alias(END), F.lit(True).alias(CURRENT)
    )
    return closed.unionByName(renewed).unionByName(unseen)


def scd2_on(dim: DataFrame, date) -> DataFrame:
    """The versions valid on a date."""
    day = F.lit(date).cast("date")
    return dim.filter((F.col(START) <= day) & (F.col(END).isNull() | (day < F.col(END))))


def overlaps(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Versions that start before the version ahead of them has ended.

    Empty exactly when no two versions of a key overlap: if any two do, then
    so do two neighbours.
    """
    # An open version reaches past every date.
    reach = F.coalesce(F.col(END), F.lit("9999-12-31").cast("date"))
    lined = lag_lead(dim.withColumn("__reach", reach), keys, [START], ["__reach"], lags={"__prev": ("__reach", 1, None)})
    return lined.filter(F.col(START) < F.col("__prev")).drop("__reach", "__prev")
