"""Streaming order monitor: landing files -> judged micro-batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators.quality import Ref, Rule, positive, sides
from tidemark.streaming.batches import judged_batch_writer
from tidemark.streaming.runs import run_available
from tidemark.streaming.sources import stream_files


@dataclass(frozen=True)
class Monitored:
    """What the monitor has written so far."""

    query: StreamingQuery
    silver: DataFrame
    dead: DataFrame


def monitor(
    stream: DataFrame, rules: list[Rule], refs: list[Ref], out: str, checkpoint: str, timeout: int | None = None
) -> Monitored:
    """Drain a stream of orders into a judged table; safe to restart and to replay."""
    query = run_available(stream, checkpoint, batch=judged_batch_writer(out, rules, refs), timeout=timeout)
    good, dead = sides(stream.sparkSession.read.parquet(out))
    return Monitored(query, good, dead)


def run(
    spark: SparkSession, landing: str, staff: DataFrame, out: str, checkpoint: str, max_files: int | None = None
) -> Monitored:
    """Monitor landing-zone CSV orders against the known employees."""
    stream = stream_files(spark, landing, schemas.landing_orders(), "csv", max_files)
    refs = [Ref("unknown_emp_id", "emp_id", staff, "emp_id")]
    return monitor(stream, [positive("amount")], refs, out, checkpoint)
