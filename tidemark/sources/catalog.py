"""Managed and external tables, views, and what the catalog says about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_managed(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    """Spark owns the files: dropping the table deletes them."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Only the name is Spark's: dropping the table keeps the files."""
    spark.catalog.createTable(name, path=path, source=fmt)


def describe_tables(spark: SparkSession) -> list[tuple[str, str, bool]]:
    """(name, type, is temporary) for the current database."""
    return [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]


def describe_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]


def is_managed(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "MANAGED"


def drop_table(spark: SparkSession, name: str, delete_files: bool = False) -> None:
    """Drop a table; a managed one only when the loss of its files is accepted."""
    if is_managed(spark, name) and not delete_files:
        raise PermissionError(f"{name} is managed: dropping it deletes its files")
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})


def session_view(df: DataFrame, name: str) -> None:
    """Visible in this session only."""
    df.createOrReplaceTempView(name)


def global_view(df: DataFrame, name: str) -> str:
    """Visible to every session of the application, under the returned name."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"
