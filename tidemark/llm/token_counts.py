"""Token counts behind a digest cache.

Contents are known by the digest of their normalised text.  Digests are joined
to the counts stored for this version of the tokenizer; only distinct misses
are encoded, and appended to the cache.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.worker import remembered, small_batches

CACHE = "content string, tokenizer string, n_tokens long"
#: Counts of words kept per Python worker; beyond it the memory is emptied.
REMEMBERED = 1_000_000
MARK = "▁"
SEGMENT = re.compile(f"[ {MARK}]+[^ {MARK}]*")


class PieceCounter:
    """Number of pieces of whole texts under a sentencepiece model.

    No piece of such a model has a space after another character (checked), so
    a text's count is the sum over its words, each with the spaces before it;
    counts of words seen before are looked up.  Models with other spacing rules
    encode whole texts.
    """

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = proto.normalizer_spec
        self.by_word = (
            rules.add_dummy_prefix
            and rules.escape_whitespaces
            and not rules.remove_extra_whitespaces
            and not rules.precompiled_charsmap
            and not any(piece.type == piece.USER_DEFINED for piece in proto.pieces)
            and not any(MARK in piece.piece.lstrip(MARK) for piece in proto.pieces)
        )
        self.words: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.processor.encode(text))

    def __call__(self, text: str) -> int:
        if not text or not self.by_word:
            return self.whole(text)
        # The model puts one space before the text, as it would before each word alone.
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            words = [segment[1:] for segment in SEGMENT.findall(" " + text)]
        else:
            words = text.split(" ")
        known = self.words
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            # A lone space at the end: the space is all there is.
            known[word] = self.whole(word) if word else 1
        return sum(map(known.__getitem__, words))


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def normalised(text):
    """What the digest is taken of: NULL counts as empty.

    The model takes texts as they are (no Unicode or case folding), so any
    further folding would give two contents of different counts one digest.
    """
    return F.coalesce(text, F.lit(""))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version; empty where there is no cache yet."""
    try:
        found = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], CACHE)
    # Two jobs may have stored the same content at the same time.
    return found.filter(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_misses(docs: DataFrame, model_path: str, cache_path: str, text: str = "text") -> None:
    """Encode the distinct contents that the cache lacks, and append their counts."""
    spark = docs.sparkSession
    small_batches(spark)
    version = tokenizer_digest(model_path)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = remembered(f"pieces of {version}", lambda: PieceCounter(model.value))
        for batch in batches:
            yield pd.DataFrame({"content": batch["content"], "n_tokens": [counter(t) for t in batch["body"]]})

    body = normalised(F.col(text))
    contents = docs.select(F.sha2(body, 256).alias("content"), body.alias("body"))
    known = read_cache(spark, cache_path, version)
    # Copies meet before the shuffle, so a text that fills a third of the rows is sent once per task.
    misses = contents.dropDuplicates(["content"]).join(known, "content", "left_anti")
    counted = misses.mapInPandas(encode, "content string, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)


def token_counts(
    docs: DataFrame,
    model_path: str,
    cache_path: str,
    limit: int = 4096,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    Updates the cache at ``cache_path`` (a table in a folder that all executors
    share) first, then reads every count from it.  No begin, end or other
    special token is counted.  NULL and empty texts have 0 bytes and 0 tokens;
    null keys and repeated rows give one row each; other columns are ignored.
    """
    count_misses(docs, model_path, cache_path, text)
    body = normalised(F.col(text))
    rows = docs.select(
        F.col(key), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("__content")
    )
    stored = read_cache(docs.sparkSession, cache_path, tokenizer_digest(model_path))
    # Copies share a digest: the planner broadcasts a small cache and splits a skewed key otherwise.
    return rows.join(stored, rows["__content"] == stored["content"]).select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
