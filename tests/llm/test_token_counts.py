from collections import Counter

import public_tokenizers
import sentencepiece

from tests.llm.cases import awkward_docs, awkward_texts, no_docs
from tidemark.llm.token_counts import PieceCounter, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_counter_equals_the_library():
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    with open(PATH, "rb") as file:
        counter = PieceCounter(file.read())
    assert counter.by_word
    for text in ["", " ", "  a  b ", "▁a▁ b", "a\nb \n c", "\n", "a▁▁", "日本 語", "\x00 a\x00b", "é́ x", "\t a", "<s> a </s>", "a " * 9]:
        assert counter(text) == len(processor.encode(text)), text


def test_counts_and_cache(spark, tmp_path):
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    cache = str(tmp_path / "cache")
    docs = awkward_docs(spark)
    expected = Counter(
        (key, len((text or "").encode()), len(processor.encode(text or ""))) for key, text in awkward_texts()
    )
    first = token_counts(docs.filter("doc_id < 9"), PATH, cache)
    assert first.count() == 8
    stored = spark.read.parquet(cache).count()
    rows = token_counts(docs, PATH, cache, limit=100).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in rows)
    # The second call encoded only what was new, and each content once.
    table = spark.read.parquet(cache)
    assert table.count() == table.select("content").distinct().count() > stored


def test_empty_table(spark, tmp_path):
    assert token_counts(no_docs(spark), PATH, str(tmp_path / "none")).count() == 0
