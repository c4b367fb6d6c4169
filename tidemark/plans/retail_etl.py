"""Retail sales: raw orders -> bronze -> quarantine -> enriched orders -> totals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalars import cents, exact_sum, money_sum
from tidemark.operators.quality import (
    REASONS,
    Ref,
    Rule,
    keep_known,
    keep_valid,
    positive,
    sides,
    split_bad,
    tag,
)
from tidemark.sources.files import read_csv
from tidemark.sources.sinks import write_slice


@dataclass(frozen=True)
class Layers:
    """The tables of one run, as DataFrames."""

    bronze: DataFrame
    dead: DataFrame
    silver: DataFrame
    gold: dict[str, DataFrame]


def totals(silver: DataFrame, by: list[str], amount: str = "amount") -> DataFrame:
    """Gold: revenue and order count per group."""
    return silver.groupBy(*by).agg(
        money_sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("order_count")
    )


def totals_by_account(
    orders: DataFrame, accounts: DataFrame, rules: list[Rule], refs: list[Ref], on: list[str], by: list[str], amount: str
) -> DataFrame:
    """The same totals straight from the orders, combined before any join.

    Valid orders shrink to one row per account and order-side group on the map
    side; only those rows meet the references and the accounts, so an account
    with a third of all orders weighs one row per task.
    """
    side = list(dict.fromkeys([*on, *(r.column for r in refs), *(c for c in by if c in orders.columns)]))
    per = (
        keep_valid(orders, rules)
        .groupBy(*side)
        .agg(F.sum(cents(amount)).alias("__cents"), F.count(F.lit(1)).alias("__orders"))
    )
    return (
        keep_known(per, refs)
        .join(accounts, on)
        .groupBy(*by)
        .agg(
            (exact_sum(F.col("__cents")).cast("double") / 100).alias("total_amount"),
            F.sum("__orders").alias("order_count"),
        )
    )


def build(
    orders: DataFrame,
    accounts: DataFrame,
    rules: list[Rule],
    refs: list[Ref],
    on: list[str],
    golds: dict[str, list[str]],
    amount: str = "amount",
) -> Layers:
    """The whole job as DataFrames, without I/O."""
    good, dead = split_bad(orders, rules, refs)
    gold = {n: totals_by_account(orders, accounts, rules, refs, on, by, amount) for n, by in golds.items()}
    return Layers(orders, dead, good.join(accounts, on), gold)


def append_bronze(df: DataFrame, path: str, batch: str) -> None:
    """Append a batch as it came, with the batch it came in and when; a re-send adds rows, nothing is lost.

    Running the same batch again after a failure replaces only what it wrote.
    """
    stamped = df.withColumn("ingested_at", F.current_timestamp())
    write_slice(stamped, path, "ingest_batch", batch)


def run_tables(
    spark: SparkSession,
    orders: DataFrame,
    accounts: DataFrame,
    out: str,
    rules: list[Rule],
    refs: list[Ref],
    on: list[str],
    golds: dict[str, list[str]],
    amount: str = "amount",
    batch: str = "0",
) -> Layers:
    """Append a batch to bronze, then write silver, dead letters and the golds from all of bronze.

    Rows are judged once; the two outcomes are partitions of one table.  The
    accounts are joined once, into silver, and the golds read silver.
    """
    append_bronze(orders, f"{out}/bronze", batch)
    bronze = spark.read.parquet(f"{out}/bronze")
    judged = tag(bronze, rules, refs).withColumn("is_dead", F.size(REASONS) > 0)
    judged.write.mode("overwrite").partitionBy("is_dead").parquet(f"{out}/judged")
    good, dead = sides(spark.read.parquet(f"{out}/judged"))
    good.join(accounts, on).write.mode("overwrite").parquet(f"{out}/silver")
    silver = spark.read.parquet(f"{out}/silver")
    for name, by in golds.items():
        totals(silver, by, amount).write.mode("overwrite").parquet(f"{out}/gold_{name}")
    return Layers(bronze, dead, silver, {name: spark.read.parquet(f"{out}/gold_{name}") for name in golds})


def run(spark: SparkSession, orders_csv: str, staff_csv: str, out: str, batch: str = "0") -> Layers:
    """The job over landing files of orders and staff."""
    read_csv(spark, staff_csv, schemas.staff()).write.mode("overwrite").parquet(f"{out}/bronze_staff")
    people = spark.read.parquet(f"{out}/bronze_staff").select("emp_id", "name", "department")
    return run_tables(
        spark, read_csv(spark, orders_csv, schemas.landing_orders()), people, out, [positive("amount")],
        [Ref("unknown_emp_id", "emp_id", people, "emp_id")], ["emp_id"],
        {"region": ["region"], "department": ["department"], "employee": ["emp_id", "name"]}, batch=batch,
    )
