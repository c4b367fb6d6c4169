import json
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import awkward_docs, awkward_texts, no_docs
from tidemark.llm import bpe_stream
from tidemark.llm.bpe_stream import Decoder, Encoder, Transducer, byte_letters, decode, encode, lookahead

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def definition():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder(definition):
    return Encoder(definition)


def ids_of(encoder, text):
    return np.frombuffer(b"".join(encoder(text)), "<u4").tolist()


def toy(rules):
    """A merge list over a and b, with all bytes in front."""
    vocabulary = {letter: i for i, letter in enumerate(byte_letters())}
    for a, b in rules:
        vocabulary[a + b] = len(vocabulary)
    return Transducer(vocabulary, rules)


def plain_merge(transducer, piece):
    ids = [transducer.byte_ids[byte] for byte in piece]
    while True:
        found = [(transducer.rules[pair], at) for at, pair in enumerate(zip(ids, ids[1:])) if pair in transducer.rules]
        if not found:
            return ids
        at = min(found)[1]
        ids[at : at + 2] = [transducer.made[transducer.rules[ids[at], ids[at + 1]]]]


def random_rules(pick):
    tokens, rules = ["a", "b"], []
    for _ in range(pick.randint(1, 12)):
        a, b = pick.choice(tokens), pick.choice(tokens)
        if a + b not in tokens:
            tokens.append(a + b)
            rules.append((a, b))
    return rules


def test_lookahead_holds_for_random_merge_lists():
    """Cutting a text short changes no token that ends further than the lookahead from the cut."""
    pick = random.Random(1)
    needed = 0
    for _ in range(400):
        transducer = toy(random_rules(pick))
        for _ in range(20):
            text = bytes(pick.choice(b"ab") for _ in range(pick.randint(1, 60)))
            cut = pick.randint(0, len(text))
            whole, part = plain_merge(transducer, text), plain_merge(transducer, text[:cut])
            at = 0
            for x, y in zip(whole, part):
                if x != y:
                    break
                at += transducer.lengths[x]
            # Tokens agree up to here, so all that ends by then is stable.
            ends = np.cumsum([transducer.lengths[i] for i in part])
            assert all(end <= at for end in ends if end <= cut - transducer.lookahead)
            needed = max(needed, cut - at)
    assert needed > 5


def test_stream_equals_merging_everything():
    pick = random.Random(2)
    for _ in range(300):
        transducer = toy(random_rules(pick))
        text = bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 300)))
        step = pick.randint(1, 50)
        parts = [text[at : at + step] for at in range(0, len(text), step)]
        assert sum(transducer.stream(parts), []) == plain_merge(transducer, text) == transducer.merged(text)
        assert transducer._merged_short(text) == transducer._merged_long(text)


def test_merge_lists_that_do_not_go_in_order_are_refused():
    with pytest.raises(ValueError, match="made"):
        lookahead([("a", "b"), ("ab", "a"), ("b", "a"), ("a", "ba")])


def test_memory_does_not_grow_with_the_word(encoder):
    transducer = encoder.words.transducer
    assert transducer.lookahead == 320
    held = []
    merged = transducer.merged
    transducer.merged = lambda piece: held.append(len(piece)) or merged(piece)
    try:
        step = 4 * transducer.lookahead
        word = b"abcab" * 40_000
        count = sum(len(ids) for ids in transducer.stream(word[at : at + step] for at in range(0, len(word), step)))
    finally:
        del transducer.merged
    assert count > 10_000 and max(held) <= 6 * transducer.lookahead


def test_encoder_equals_the_library(encoder, library):
    pick = random.Random(3)
    texts = [text or "" for _, text in awkward_texts()]
    texts += ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|ENDOFTEXT|>", "it's I'LL we'd", "   x\x85y\x1cz", "a\n\n b \t", " " * 400]
    texts += ["".join(pick.choice("ab ") for _ in range(3000)), "x" * 70_000, "՘࢏ letters of another Unicode version ౜", "日本語" * 500]
    for _ in range(3000):
        chars = pick.choice(["ab c", "aä \n", "a1! '", "́e​ x", "😀👍🏽 a", "ĠÀÿ÷ "]) + "st'"
        texts.append("".join(pick.choice(chars) for _ in range(pick.randint(0, 60))))
    for _ in range(500):
        texts.append("".join(chr(pick.choice([pick.randrange(0xD800), pick.randrange(0xE000, 0x110000), 32])) for _ in range(20)))
    for text in texts:
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids, text[:100]


def test_latin_characters_are_of_the_kinds_spelt_out(encoder):
    for char in sorted(bpe_stream.LATIN):
        spelt = tuple(bool(re.match(f"[{kind}]", char)) for kind in (bpe_stream._LETTER, bpe_stream._NUMBER, bpe_stream._SPACE))
        assert encoder.kind(char) == spelt, hex(ord(char))


def test_long_texts_in_portions(encoder, library):
    pick = random.Random(4)
    text = " ".join("".join(pick.choice("aeinrst,.'") for _ in range(pick.randint(1, 9))) for _ in range(60_000))
    assert len(list(encoder(text))) > 3
    assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_decoder_equals_the_library(definition, library):
    decoder, pick = Decoder(definition), random.Random(5)
    for _ in range(500):
        ids = [pick.choice([pick.randrange(256), pick.randrange(50_257)]) for _ in range(pick.randint(0, 40))]
        cut = pick.randint(0, len(ids))
        runs = [np.array(ids[:cut], "<u4"), np.array(ids[cut:], "<u4")]
        assert "".join(decoder(runs)) == library.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
            bpe_stream._supported(json.loads(file.read()))


def test_awkward_rows(spark, library):
    rows = decode(encode(awkward_docs(spark), PATH), PATH).collect()
    expected = [(key, text, library.encode(text or "", add_special_tokens=False).ids) for key, text in awkward_texts()]
    found = [(r["doc_id"], r["text"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert all((r["content"], r["words"]) == ("x", "w") for r in rows)


def test_columns_named_like_the_results(spark):
    docs = awkward_docs(spark).withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit(1))
    other = decode(encode(docs, PATH, ids="tokens"), PATH, ids="tokens", text="again")
    assert other.filter("ids = 'mine' AND decoded = 1 AND again = coalesce(text, '')").count() == len(awkward_texts())


def test_empty_table_and_missing_ids(spark):
    assert decode(encode(no_docs(spark), PATH), PATH).count() == 0
    assert decode(spark.createDataFrame([(None,)], "ids binary"), PATH).first()["decoded"] == ""
