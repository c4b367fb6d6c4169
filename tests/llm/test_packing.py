import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import awkward_docs, awkward_texts, no_docs
from tidemark.llm import packing
from tidemark.llm.packing import WordEncoder, cut, pack_binary, write_buckets

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_cut_is_binary():
    assert cut(1, 8) == [(0, 1)]
    assert cut(21, 8) == [(0, 8), (8, 8), (16, 4), (20, 1)]
    assert cut(0, 8) == []


def test_pieces_hold_every_id_once(spark):
    tokenizer = Tokenizer.from_file(PATH)
    expected = {}
    for key, text in awkward_texts():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.setdefault(key, []).append(ids)
    rows = pack_binary(awkward_docs(spark), PATH, max_tokens=1024).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    got = {}
    for r in rows:
        assert r["length"] == 1 << r["bucket"] <= 1024 and r["offset"] == 0
        assert len(r["ids"]) == 4 * r["length"]
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    for key, texts in expected.items():
        for ids in texts:
            same = texts.count(ids)
            pieces = sorted(p for p in got[(key, len(ids))])
            longest = [p for p in pieces if ids[p[0] : p[0] + len(p[1])] == p[1]]
            assert sum(len(p[1]) for p in longest) >= same * len(ids)


def test_parameters_and_empty_input(spark, tmp_path):
    with pytest.raises(ValueError):
        pack_binary(no_docs(spark), PATH, max_tokens=1000)
    assert pack_binary(no_docs(spark), PATH).count() == 0
    pieces = pack_binary(awkward_docs(spark).filter("doc_id < 8"), PATH)
    write_buckets(pieces, str(tmp_path / "buckets"))
    read = spark.read.parquet(str(tmp_path / "buckets"))
    assert read.count() == pieces.count()
    crc = {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in pieces.collect() if r["doc_id"]}
    assert {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in read.collect()} == crc


def test_special_tokens_in_other_case_are_text():
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as file:
        encoder = WordEncoder(file.read())
    for text in ("hello <|ENDOFTEXT|> world", "a<|StartOfText|>b", "hello <|endoftext|> world", "HELLO world"):
        ids = np.frombuffer(encoder(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_looked_up_lately_outlive_the_others(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    encoder = WordEncoder(Path(PATH).read_text(encoding="utf-8"))
    plain, asked = encoder.words.encode, []
    encoder.words.encode = lambda word: asked.append(word) or plain(word)
    for i in range(100):
        text = f"often {' '.join(f'word{i}x{j}' for j in range(10))}"
        assert encoder(text) == encoder.whole(text)
        assert len(encoder.words) + len(encoder.words.older) <= packing.REMEMBERED + 2 * 11
    assert asked.count("often") == 1


def test_words_of_letters_only_are_encoded_like_the_tokenizer():
    encoder = WordEncoder(Path(PATH).read_text(encoding="utf-8"))
    pick, letters = random.Random(7), "".join(map(chr, encoder.letters))
    assert {*"azßéÿő"} <= {*letters} and not {*"A1µ' "} & {*letters}
    words = ["".join(pick.choices(some, k=pick.randint(1, 30))) for some in (letters, letters[:26], "aeéèns") for _ in range(2000)]
    assert [w for w in words if encoder.word(w) != encoder.whole(w)] == []
