"""Daily load: parse -> dead letters -> value checks -> slice overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import REASONS, Rule, sides
from tidemark.sources.files import CORRUPT, read_marked
from tidemark.sources.sinks import write_slice


def judge(marked: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reasons``: unparseable records first, then failed value checks."""
    parsed = F.col(CORRUPT).isNull()
    names = [F.when(~parsed, F.lit("unparseable"))]
    names += [F.when(parsed & ~F.coalesce(r.predicate, F.lit(False)), F.lit(r.name)) for r in rules]
    return marked.withColumn(REASONS, F.array_compact(F.array(*names)))


def run(
    spark: SparkSession, raw: str, schema: T.StructType, rules: list[Rule], load_date: str, out: str, fmt: str = "json"
) -> tuple[DataFrame, DataFrame]:
    """Load one day; returns ``(silver, dead)`` of all days.

    Good and dead rows go out in one write that replaces the day's slice on
    both sides, so a repeated run leaves the same rows.  The raw text of a
    broken record stays with its dead letter.
    """
    judged = judge(read_marked(spark, raw, schema, fmt), rules).withColumn("is_dead", F.size(REASONS) > 0)
    write_slice(judged, out, "load_date", load_date, ["is_dead"])
    good, dead = sides(spark.read.parquet(out))
    return good.drop(CORRUPT), dead
