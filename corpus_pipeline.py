"""Corpus pipeline: from raw documents to packed training sequences.

Stages run in this order, each over everything its predecessor kept: toxic
documents go, one document of each group of near duplicates stays, documents
with benchmark passages go, live-looking secrets are replaced, and the rest is
packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, near_dup, packing, secret_scan, toxicity
from tidemark.session import cut_lineage, split_skewed_joins


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below 0.7; no text or column is changed, whatever its name.

    NULL and empty texts score as texts without words and stay; rows without a
    key are scored like others; repeated rows are judged alike; an empty table
    stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_documents(docs, labels, threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by 80 % common five-word shingles.

    Documents without words, and rows without a key, are linked with nothing and
    stay; rows that repeat a kept document stay as many as they were; other
    columns are kept, whatever their names; an empty table stays empty.
    """
    found = cut_lineage(near_dup.near_duplicates(docs, size=5, percent=80))
    return near_dup.drop_copies(docs, found)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark.

    NULL and empty texts have no windows and stay, as do clean rows without a
    key; repeated rows are judged alike; other columns are kept, whatever their
    names; an empty table, or an empty benchmark, changes nothing.
    """
    hits = decontaminate.find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    return decontaminate.drop_contaminated(docs, hits)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, live-looking secrets replaced; ``n_chars`` follows the text where there is one.

    NULL texts stay NULL, with their ``n_chars`` NULL; rows without a key and
    repeated rows are redacted like others; other columns are kept, whatever
    their names; an empty table stays empty.
    """
    clean = secret_scan.redact(docs, secret_scan.scan_secrets(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, 4096 at most.

    A NULL or empty text is one piece holding the end id; repeated rows are
    packed once each; an empty table gives no sequence.
    """
    return packing.pack_binary(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, max_tokens=4096)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack),
]
#: Scores, sketches and token ids are beyond SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of all documents that the stages keep."""
    split_skewed_joins(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
