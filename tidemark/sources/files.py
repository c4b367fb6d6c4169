"""File readers: explicit schemas, and malformed records kept visible."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path, schema: T.StructType, mode: str = "PERMISSIVE", **options) -> DataFrame:
    """Typed CSV.  ``mode``: PERMISSIVE, DROPMALFORMED or FAILFAST."""
    return spark.read.options(**options).csv(path, header=True, schema=schema, mode=mode)


def read_csv_inferred(spark: SparkSession, path) -> DataFrame:
    """For a first look only: an extra pass, and ``00501`` becomes 501."""
    return spark.read.csv(path, header=True, inferSchema=True)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """A copy of the schema with the corrupt-record column (``add`` would change the original)."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_marked(spark: SparkSession, path, schema: T.StructType, fmt: str = "csv", **options) -> DataFrame:
    """Every record, with the raw text in ``_corrupt_record`` when anything failed."""
    reader = spark.read.schema(with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        return reader.options(**{"header": True, **options}).csv(path, mode="PERMISSIVE")
    if fmt == "json":
        return reader.options(**options).json(path, mode="PERMISSIVE")
    raise ValueError(f"no corrupt-record column for {fmt}")


def parse_lines(spark: SparkSession, path, schema: T.StructType, fmt: str = "csv", **options) -> DataFrame:
    """Every line parsed as one record, its raw text in ``_corrupt_record`` when anything failed.

    Lines come in as text and are parsed by an expression, so that one plan
    holds both the record and its raw form and nothing is written.  The whole
    record is parsed whichever columns are used later.  Blank lines are no
    records, as in the readers.  With a CSV header, lines equal to the first one
    are headers (every file of a folder repeats it).
    """
    told = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    told = {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in told.items()}
    reader = spark.read.option("lineSep", options["lineSep"]) if "lineSep" in options else spark.read
    lines = reader.text(path).filter(F.trim("value") != "")
    wanted = with_corrupt(schema)
    if fmt == "json":
        record = F.from_json("value", wanted, told)
    elif fmt == "csv":
        if told.pop("header", "true") == "true":
            first = lines.select("value").head()
            lines = lines.filter(F.col("value") != F.lit(first["value"])) if first else lines
        record = F.from_csv(F.col("value"), wanted.toDDL(), told)
    else:
        raise ValueError(f"no corrupt-record column for {fmt}")
    # Both sides read the struct as a whole: a parser that is asked for one field only skips the others' errors.
    other = [name for name in lines.columns if name != "value"]
    parsed = lines.select(record.alias("record"), *other).filter(F.length(F.col("record").cast("string")) > 0)
    return parsed.select("record.*", *other)


def read_with_quarantine(
    spark: SparkSession, path, schema: T.StructType, fmt: str = "csv", **options
) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantine)``; the quarantine keeps the raw text.  Nothing is written.

    Only where a record may span lines (``multiLine``), or the files are not
    UTF-8, the reader itself has to parse; then the records are stored once, as a
    plan that touches only the corrupt column would parse nothing.
    """
    if any(options.get(name) for name in ("multiLine", "encoding", "charset")):
        marked = cut_lineage(read_marked(spark, path, schema, fmt, **options))
    else:
        marked = parse_lines(spark, path, schema, fmt, **options)
    return marked.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), marked.filter(F.col(CORRUPT).isNotNull())


def reliable_count(df: DataFrame) -> int:
    """Rows actually parsed, for frames read from text with malformed records.

    A bare count reads no column and so parses nothing; one aggregate that
    looks at every column does, without writing anything.
    """
    whole = F.length(F.struct(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(whole).alias("seen")).first()["n"]


def read_json_lines(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per line."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_json_document(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """A whole file as one JSON value, such as an indented array."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=True)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_orc(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.orc(*paths)


def read_avro(spark: SparkSession, path) -> DataFrame:
    """Needs Spark's external Avro module on the class path."""
    return spark.read.format("avro").load(path)


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of several schema generations; absent columns are NULL.

    Without merging, the schema of one arbitrary file would stand for all.
    """
    return spark.read.option("mergeSchema", True).parquet(*paths)
