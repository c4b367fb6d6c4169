"""Quality gates, dead-letter splits and layer reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reasons"


class DataQualityError(Exception):
    """Raised by a gate; carries every failed check."""

    def __init__(self, failures: list[str]):
        self.failures = failures
        super().__init__("; ".join(failures))


@dataclass(frozen=True)
class Rule:
    """A row is good when ``predicate`` is true; NULL counts as bad."""

    name: str
    predicate: Column


@dataclass(frozen=True)
class Ref:
    """``column`` must hold a value found in ``parent.parent_column``."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str


def not_null(column: str) -> Rule:
    return Rule(f"{column}_missing", F.col(column).isNotNull())


def positive(column: str) -> Rule:
    return Rule(f"{column}_not_positive", F.col(column) > 0)


def _with_refs(df: DataFrame, refs: list[Ref]) -> DataFrame:
    """One boolean column per reference: is the key known?"""
    for i, ref in enumerate(refs):
        known = ref.parent.select(F.col(ref.parent_column).alias(f"__ref_{i}")).distinct()
        df = df.join(known, F.col(ref.column) == F.col(f"__ref_{i}"), "left")
    return df


def _bad(rules: list[Rule], refs: list[Ref]) -> list[tuple[str, Column]]:
    bad = [(r.name, ~F.coalesce(r.predicate, F.lit(False))) for r in rules]
    return bad + [(r.name, F.col(f"__ref_{i}").isNull()) for i, r in enumerate(refs)]


def tag(df: DataFrame, rules: list[Rule], refs: list[Ref] | None = None) -> DataFrame:
    """Add ``reasons``: the names of all checks the row fails, empty when good.

    Each row is judged by itself: a bad copy does not take good rows with the
    same id along, and identical rows stay as many as they were.
    """
    refs = refs or []
    names = [F.when(bad, F.lit(name)) for name, bad in _bad(rules, refs)]
    tagged = _with_refs(df, refs).withColumn(REASONS, F.array_compact(F.array(*names)))
    return tagged.drop(*[f"__ref_{i}" for i in range(len(refs))])


def keep_valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows passing every rule, as plain filters that can reach the scan."""
    for rule in rules:
        df = df.filter(rule.predicate)
    return df


def keep_known(df: DataFrame, refs: list[Ref]) -> DataFrame:
    """Rows whose references all exist."""
    for i, ref in enumerate(refs):
        known = ref.parent.select(F.col(ref.parent_column).alias(f"__ref_{i}")).distinct()
        df = df.join(known, F.col(ref.column) == F.col(f"__ref_{i}"), "left_semi")
    return df


def split_bad(df: DataFrame, rules: list[Rule], refs: list[Ref] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, dead)``; dead rows keep their ``reasons``.

    The good side needs no reasons, so it is read with pushed-down filters and
    semi joins; together the two sides hold every row exactly once.
    """
    refs = refs or []
    return keep_known(keep_valid(df, rules), refs), tag(df, rules, refs).filter(F.size(REASONS) > 0)


def sides(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, dead)`` of a table written with an ``is_dead`` partition column.

    Folder names come back as text, hence the cast; it still prunes folders.
    """
    is_dead = F.col("is_dead").cast("boolean")
    return judged.filter(~is_dead).drop("is_dead", REASONS), judged.filter(is_dead).drop("is_dead")


def profile(df: DataFrame, rules: list[Rule], refs: list[Ref] | None = None) -> DataFrame:
    """One row: ``row_count`` and the number of bad rows per check."""
    refs = refs or []
    return _with_refs(df, refs).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count_if(bad).alias(name) for name, bad in _bad(rules, refs)]
    )


def gate(df: DataFrame, rules: list[Rule], refs: list[Ref] | None = None, min_rows: int = 1) -> dict[str, int]:
    """Raise ``DataQualityError`` with all failures, or return the measured counts.

    The volume check matters: every per-row check passes on an empty batch.
    """
    counts = profile(df, rules, refs).first().asDict()
    failures = []
    if counts["row_count"] < min_rows:
        failures.append(f"expected at least {min_rows} row(s), got {counts['row_count']}")
    failures += [f"{name}: {bad} row(s)" for name, bad in counts.items() if name != "row_count" and bad]
    if failures:
        raise DataQualityError(failures)
    return counts


def dead_letter_rate(tagged: DataFrame, by: list[str], limit: float) -> DataFrame:
    """Share of rejected rows per group, and whether it exceeds ``limit``."""
    rows, dead = F.count(F.lit(1)), F.count_if(F.size(REASONS) > 0)
    return (
        tagged.groupBy(*by)
        .agg(rows.alias("row_count"), dead.alias("dead_count"))
        .withColumn("dead_rate", F.col("dead_count").cast("double") / F.col("row_count").cast("double"))
        .withColumn("alert", F.col("dead_rate") > limit)
    )


def reconcile(bronze: DataFrame, silver: DataFrame, dead: DataFrame) -> DataFrame:
    """One row with the three counts and whether they add up."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    layers = (
        bronze.select(one.alias("b"), none.alias("s"), none.alias("d"))
        .union(silver.select(none, one, none))
        .union(dead.select(none, none, one))
    )
    return layers.agg(
        F.coalesce(F.sum("b"), none).alias("bronze_rows"),
        F.coalesce(F.sum("s"), none).alias("silver_rows"),
        F.coalesce(F.sum("d"), none).alias("dead_rows"),
    ).withColumn("balanced", F.col("bronze_rows") == F.col("silver_rows") + F.col("dead_rows"))
