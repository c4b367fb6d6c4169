"""Packing by power-of-two decomposition.

Every document is cut into pieces whose lengths are the binary digits of its
token count.  A piece is a whole sequence of its bucket (one bucket per
length), so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.worker import remembered, small_batches

#: Texts of these characters only are encoded word by word (see ``WordEncoder``).
PLAIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-öø-įı-ɏ]*")
#: Words kept per Python worker at most; those not looked up lately go first.
REMEMBERED = 600_000
#: The bucket stands above this bit of a sequence id.
BUCKET_SHIFT = 58


class KnownWords(dict):
    """Ids of words; those of a new word are worked out when it is looked up."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        #: The words before the last ``age``.
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            # The mark behind a word is a token of its own, so the word is looked up without it.
            if len(word) > 1 and word[-1] in ".,|" and word[-2].isalpha():
                ids = self[word[:-1]] + self[word[-1]]
            else:
                ids = self.encode(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        """Forget what was not looked up since the last time."""
        self.older = dict(self)
        self.clear()


class WordEncoder:
    """Token ids of whole texts, as packed little-endian unsigned 32-bit numbers.

    The tokenizer lower-cases and drops white space, so a text's ids are those
    of its words, one after the other; ids of words seen before are looked up.
    Texts with other characters than ``PLAIN`` (case folding and composition
    look across words there) or with a special token, in whatever case, go through
    it whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.words = KnownWords(self.word)
        self.model = self.tokenizer.model
        self.letters, self.bare = self.lone_letters()

    def lone_letters(self) -> tuple[dict[int, str], re.Pattern]:
        """How the model gets to see lower-case Latin letters, and the words of these only.

        There are none if the tokenizer changes such letters, or does not keep them together.
        """
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters = [c for c in map(chr, range(0x61, 0x250)) if c.isalpha() and c == c.lower() and PLAIN.fullmatch(c)]
        shown = {}
        if normal and split:
            shown = {ord(c): "".join(piece for piece, _ in split.pre_tokenize_str(c)) for c in letters}
            joined = "".join(letters)
            if normal.normalize_str(joined) != joined or [x for x, _ in split.pre_tokenize_str(joined)] != ["".join(shown.values())]:
                shown = {}
        return shown, re.compile(f"[{''.join(letters)}]+" if shown else r"(?!)")

    def word(self, word: str) -> bytes:
        """A word of Latin letters only is one piece of the model, which is asked without the steps before it."""
        if not self.bare.fullmatch(word):
            return self.whole(word)
        seen = word if word.isascii() else word.translate(self.letters)
        return np.array([token.id for token in self.model.tokenize(seen)], "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        lowered = text.lower()
        # The name of a special token in other case is text, but its lower-cased word would be the token.
        if not PLAIN.fullmatch(text) or self.special.search(text) or self.special.search(lowered):
            return self.whole(text)
        if len(self.words) > REMEMBERED // 2:
            self.words.age()
        return b"".join(map(self.words.__getitem__, lowered.split()))


def cut(count: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: full lengths first, then the binary digits of the rest."""
    lengths = [longest] * (count // longest)
    rest = count % longest
    lengths += [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    starts = np.cumsum([0, *lengths[:-1]]).tolist() if lengths else []
    return list(zip(starts, lengths))


def pack_binary(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    max_tokens: int = 4096,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Cut ``docs`` into pieces of power-of-two lengths; one row per piece.

    Columns: the key, ``start`` (ids of the document before the piece),
    ``length``, ``bucket`` (log2 of the length), ``ids`` (binary, little-endian
    unsigned 32-bit), ``doc_tokens`` (ids of the document with ``end_id``),
    ``sequence_id`` (buckets follow each other, unique in the result) and
    ``offset`` in the sequence, always 0.

    A null or empty text is one piece holding ``end_id``; the key may be null;
    repeated rows are packed once each; other columns are ignored; an empty
    table gives an empty result.  There is no shuffle and a task holds one
    Arrow batch of texts.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    small_batches(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = remembered(f"words of {tokenizer_path}", lambda: WordEncoder(definition.value))
        for batch in batches:
            rows = []
            for doc, body in zip(batch["k"], batch["t"]):
                ids = encoder(body) + end
                count = len(ids) // 4
                rows += [
                    (doc, start, length, length.bit_length() - 1, ids[4 * start : 4 * (start + length)], count)
                    for start, length in cut(count, max_tokens)
                ]
            yield pd.DataFrame(rows, columns=["k", "start", "length", "bucket", "ids", "doc_tokens"])

    kind = docs.schema[key].dataType
    # The key travels as text: pandas would turn a nullable number into a float.
    source = docs.select(F.col(key).cast("string").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    schema = "k string, start long, length long, bucket int, ids binary, doc_tokens long"
    row = F.monotonically_increasing_id()
    return source.mapInPandas(pieces, schema).select(
        F.col("k").cast(kind).alias(key),
        "start",
        "length",
        "bucket",
        "ids",
        "doc_tokens",
        F.shiftleft(F.col("bucket").cast("long"), BUCKET_SHIFT).bitwiseOR(row).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, ready to be read as equally long sequences."""
    pieces.write.mode("errorifexists").partitionBy("bucket").parquet(path)
