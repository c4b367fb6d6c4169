"""Writers for micro-batches that may be replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import REASONS, Ref, Rule, tag
from tidemark.sources.sinks import write_slice


def batch_slice_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch into its own partition, replacing it on a replay.

    A crash between the write and the commit runs the same batch again, and
    the second write takes the place of the first.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        write_slice(df, path, "batch_id", batch_id)

    return write


def judged_batch_writer(path: str, rules: list[Rule], refs: list[Ref]) -> Callable[[DataFrame, int], None]:
    """Judge each row once and write good and dead rows in one replayable write.

    Within its batch a row is filed under ``is_dead``, so either side is read
    without touching the other, and a replay replaces both.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        judged = tag(df, rules, refs).withColumn("is_dead", F.size(REASONS) > 0)
        write_slice(judged, path, "batch_id", batch_id, ["is_dead"])

    return write
