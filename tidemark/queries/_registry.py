"""Registry: name -> (callable, oracle SQL)."""

from __future__ import annotations

import functools
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.session import split_skewed_joins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Schemas found so far by path: a footer is read once per table, not per query.
SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Attribute access to the Parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = self.path(name)
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        # Kept per query, so that a table used twice is listed once.
        frame = self.__dict__[name] = self.spark.read.schema(SCHEMAS[path]).parquet(path)
        return frame

    def sql(self, text: str, names: str, args: dict | None = None) -> DataFrame:
        """Run SQL text with the listed tables bound as ``{name}`` references."""
        frames = {name: getattr(self, name) for name in names.split()}
        return self.spark.sql(text, args=args, **frames)


def query(oracle: str | None = None, name: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``oracle`` is the DuckDB twin."""

    def register(fn):
        key = name or fn.__name__

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            split_skewed_joins(spark)
            return fn(Tables(spark, sf_dir))

        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = textwrap.dedent(oracle).strip()
        return fn

    return register
