"""Filters, casts and parameterised SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_cast


def filter_all(df: DataFrame, predicates: list[Column]) -> DataFrame:
    """Apply a run-time list of predicates; an empty list keeps every row."""
    return reduce(lambda frame, predicate: frame.filter(predicate), predicates, df)


def cast_failures(df: DataFrame, column: str, to: str) -> DataFrame:
    """Rows whose text is present but does not convert to ``to``."""
    return df.filter(F.col(column).isNotNull() & safe_cast(column, to).isNull())


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text with named parameters; values are bound, never spliced."""
    return spark.sql(text, args=args, **frames)


def allowed_name(name: str, allowed: list[str]) -> str:
    """Guard for identifiers, which cannot be bound as parameters."""
    if name not in allowed:
        raise ValueError(f"{name!r} is not one of {sorted(allowed)}")
    return name


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows satisfying ``column NOT IN (SELECT other_column FROM other)``.

    SQL rules: an empty list keeps every row, a NULL in the list keeps none,
    and a NULL on the left survives only an empty list.  Spark runs the
    subquery form by broadcasting the whole list, whatever its size; here the
    list is shuffled like any anti join, and only three numbers travel apart.
    """
    values = other.select(F.col(other_column).alias("__listed"))
    size = values.agg(F.count(F.lit(1))).scalar()
    known = values.agg(F.count("__listed")).scalar()
    kept = df.join(values, F.col(column) == F.col("__listed"), "left_anti")
    return kept.filter((size == 0) | ((size == known) & F.col(column).isNotNull()))
