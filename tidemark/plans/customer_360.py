"""Customer 360: type 2 dimension, retry-safe facts, point-in-time view."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.joins import pit_join
from tidemark.operators.scd import overlaps, scd2_apply
from tidemark.operators.tables import insert_new


class OverlappingVersionsError(ValueError):
    """Two versions of one key are valid on the same day."""


def next_dimension(dim: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str], effective) -> DataFrame:
    """The dimension after one day's changes."""
    return scd2_apply(dim, incoming, keys, tracked, effective)


def load_facts(facts: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Facts after a batch; a batch loaded again adds nothing."""
    return insert_new(facts, batch, keys)


def view(
    facts: DataFrame, dim: DataFrame, on: list[str], time: str, attributes: dict[str, str], how: str = "left"
) -> DataFrame:
    """Facts with the attributes valid when they happened.

    ``attributes`` maps a dimension column to its name in the view.
    """
    slim = dim.select(
        *on, "effective_start", "effective_end", *[dim[c].alias(name) for c, name in attributes.items()]
    )
    joined = pit_join(facts, slim, on, time, how=how)
    return joined.drop("effective_start", "effective_end")


def checked_view(facts: DataFrame, dim: DataFrame, on: list[str], time: str, attributes: dict[str, str]) -> DataFrame:
    """``view`` after making sure that no fact can match two versions."""
    clash = overlaps(dim, on).first()
    if clash is not None:
        raise OverlappingVersionsError(f"key {[clash[k] for k in on]} has overlapping versions")
    return view(facts, dim, on, time, attributes)
