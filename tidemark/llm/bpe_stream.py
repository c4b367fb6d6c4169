"""Byte-pair encoding as a streaming transducer with a bounded lookahead.

A merge list tells how far text to the right can reach back into tokens on the
left.  The transducer merges a short buffer, gives out the tokens that lie
further than this lookahead from the buffer's end, since no text to come can
change them, and goes on from there: its memory does not grow with the text.
Tokens are decoded by a state machine that keeps the bytes of one unfinished
character.

The lookahead.  Apply the merge list rule by rule to a text and to the same
text cut short.  A boundary left of which both agree moves left only when a rule
(a, b) merges the token a before it in one of the two.  The next such rule comes
later in the list, and its b begins with that a, as b now starts where a did.
So the way back is at most the summed lengths of the left parts of a chain of
rules, each later than the one before, whose right part begins (down to its
first parts) with the left part of the one before.  The longest chain is found
in one pass over the list.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.worker import remembered, small_batches

#: Characters of a text taken at a time, at a place where no word is cut.
PORTION = 1 << 16
#: Words whose ids are kept per Python worker; beyond it the memory is emptied.
REMEMBERED = 500_000
#: Ids decoded at a time.
RUN = 1 << 14
#: How such tokenizers split a text into words (fixed value: the published pattern).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The characters of most European texts, and the same pattern spelt out for them: three times as fast.
LATIN = frozenset(map(chr, [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]))
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Pieces of up to so many bytes are merged in a plain list.
SHORT = 64
#: Between these two characters a word always ends.
BREAK = re.compile(r"\S(?= \S)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such vocabularies: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(other)}


def lookahead(merges: list[tuple[str, str]]) -> int:
    """Bytes to the right beyond which no text can change a token of this merge list.

    Each rule has to make a token of its own out of bytes and tokens of earlier
    rules, so that applying the list in order is the same as merging the first
    rule that fits.
    """
    first: dict[str, str] = {}
    reach: dict[str, int] = {}
    longest = 0
    for a, b in merges:
        if a + b in first or any(len(part) > 1 and part not in first for part in (a, b)):
            raise ValueError(f"rule {a!r} {b!r} makes a token made before, or of parts not made yet")
        first[a + b] = a
        part, back = b, reach.get(b, 0)
        while part in first:
            part = first[part]
            back = max(back, reach.get(part, 0))
        reach[a] = max(reach.get(a, 0), len(a) + back)
        longest = max(longest, reach[a])
    return longest


class Transducer:
    """Bytes in, token ids out, as soon as they are certain."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        self.lookahead = lookahead(merges)
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        #: (left id, right id) -> place in the list; and the id made there.
        self.rules = {(vocabulary[a], vocabulary[b]): place for place, (a, b) in enumerate(merges)}
        self.made = [vocabulary[a + b] for a, b in merges]
        self.lengths = {i: len(token) for token, i in vocabulary.items()}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece by itself: always the first rule of the list that fits, leftmost first."""
        return self._merged_short(piece) if len(piece) <= SHORT else self._merged_long(piece)

    def _merged_short(self, piece: bytes) -> list[int]:
        """The place of the rule for each pair stands in a list; its minimum is merged next."""
        place, made, none = self.rules.get, self.made, len(self.made)
        ids = [self.byte_ids[byte] for byte in piece]
        fits = [place(pair, none) for pair in zip(ids, ids[1:])]
        while fits and (first := min(fits)) < none:
            at = fits.index(first)
            ids[at : at + 2] = [made[first]]
            del fits[at]
            if at:
                fits[at - 1] = place((ids[at - 1], ids[at]), none)
            if at < len(fits):
                fits[at] = place((ids[at], ids[at + 1]), none)
        return ids

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same with a heap of rules over a linked list, whose cost hardly grows with the length."""
        rules, made, ids = self.rules, self.made, [self.byte_ids[byte] for byte in piece]
        count = len(ids)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        pairs = enumerate(zip(ids, ids[1:]))
        heap = [(place, at, pair) for at, pair in pairs if (place := rules.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            place, at, pair = heapq.heappop(heap)
            nxt = after[at]
            # A rule noted for tokens that are merged by now no longer fits.
            if ids[at] != pair[0] or nxt >= count or ids[nxt] != pair[1]:
                continue
            ids[at], ids[nxt] = made[place], -1
            after[at] = end = after[nxt]
            around = []
            if end < count:
                before[end] = at
                around.append((at, (ids[at], ids[end])))
            if before[at] >= 0:
                around.append((before[at], (ids[before[at]], ids[at])))
            for start, pair in around:
                if (place := rules.get(pair)) is not None:
                    heapq.heappush(heap, (place, start, pair))
        return [i for i in ids if i >= 0]

    def stream(self, portions: Iterable[bytes]) -> Iterator[list[int]]:
        """Ids of one word that arrives in portions; between two of them less than two lookaheads of bytes are held."""
        held = b""
        for portion in portions:
            held += portion
            if len(held) <= 2 * self.lookahead:
                continue
            ids, settled = self.merged(held), len(held) - self.lookahead
            stable, at = 0, 0
            while (end := at + self.lengths[ids[stable]]) <= settled:
                at, stable = end, stable + 1
            # A piece between two token borders has the same tokens by itself.
            held = held[at:]
            yield ids[:stable]
        yield self.merged(held)


class WordIds(dict):
    """Packed ids of words; those of a new word are worked out when it is looked up."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> bytes:
        whole, step = word.encode(), 4 * self.transducer.lookahead + 4
        portions = (whole[at : at + step] for at in range(0, len(whole), step))
        ids = b"".join(np.array(part, "<u4").tobytes() for part in self.transducer.stream(portions))
        # A word beyond the lookahead is rare and long: not worth keeping.
        if len(whole) <= self.transducer.lookahead:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts, portion by portion, under a byte-level tokenizer file."""

    def __init__(self, definition: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        model = json.loads(definition)
        _supported(model)
        pairs = [tuple(rule.split(" ")) if isinstance(rule, str) else tuple(rule) for rule in model["model"]["merges"]]
        self.words = WordIds(Transducer(model["model"]["vocab"], pairs))
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in model["added_tokens"]}
        # The first token that fits, the longest of several.
        names = sorted(self.special, key=len, reverse=True)
        self.named = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.pattern = regex.compile(WORDS)
        self.kinds = [regex.compile(kind) for kind in (r"\p{L}", r"\p{N}", r"\s")]
        self.letters = byte_letters()
        #: Characters that the pattern and the tokenizer's own splitter take for the same kind, and others.
        self.agreed: set[str] = set()
        self.disputed: set[str] = set()

    def kind(self, char: str) -> tuple[bool, ...]:
        """Letter, number and white space, as the tokenizer's own splitter takes a character."""

        def joins(text: str) -> bool:
            return len(self.tokenizer.pre_tokenizer.pre_tokenize_str(text)) == 1

        letter, number = joins("a" + char), joins("1" + char)
        return letter, number, not letter and not number and not joins("!" + char)

    def disagreed(self, chars: set[str]) -> bool:
        """Whether the pattern and the splitter think differently of one of the characters (their Unicode versions differ)."""
        for char in chars - self.agreed - self.disputed:
            same = self.kind(char) == tuple(bool(kind.match(char)) for kind in self.kinds)
            (self.agreed if same else self.disputed).add(char)
        return not self.disputed.isdisjoint(chars)

    def split(self, text: str) -> Iterator[list[str]]:
        """The words of a text without special tokens, some at a time."""
        chars = set(text)
        latin = chars <= LATIN
        if not latin and self.disagreed(chars):
            # The tokenizer's own splitter, which writes bytes as letters.
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
                yield [bytes(map(self.letters.__getitem__, piece)).decode()]
            return
        find, at = (LATIN_WORDS if latin else self.pattern).findall, 0
        while at < len(text):
            place = BREAK.search(text, at + PORTION) if len(text) - at > PORTION else None
            end = place.end() if place else len(text)
            yield find(text[at:end])
            at = end

    def __call__(self, text: str) -> Iterator[bytes]:
        """Packed little-endian unsigned 32-bit ids, a part at a time."""
        words = self.words
        for i, part in enumerate(self.named.split(text) if self.named else [text]):
            if i % 2:
                yield self.special[part]
                continue
            for some in self.split(part):
                if len(words) > REMEMBERED:
                    words.clear()
                yield b"".join(map(words.__getitem__, some))


def _supported(model: dict) -> None:
    """Refuse tokenizer files whose rules this transducer does not know."""
    parts, pre = model["model"], model.get("pre_tokenizer") or {}
    plain = (
        parts.get("type") == "BPE"
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not model.get("normalizer")
        and not any(parts.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and not any(t.get(k) for t in model["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized"))
    )
    if not plain:
        raise ValueError("only byte-level BPE files without normalizer, prefix space, dropout and affixes are supported")


class Decoder:
    """Text of token ids that arrive in runs."""

    def __init__(self, definition: str):
        model = json.loads(definition)
        letters = byte_letters()
        tokens = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes = [b""] * (max(tokens.values(), default=-1) + 1)
        for token, i in tokens.items():
            known = all(letter in letters for letter in token)
            self.bytes[i] = bytes(map(letters.__getitem__, token)) if known else token.encode()

    def __call__(self, runs: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of each run.

        The state between two runs is the bytes of one unfinished character;
        bytes that belong to none come out as U+FFFD.
        """
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for run in runs:
            yield state.decode(b"".join(map(self.bytes.__getitem__, run.tolist())))
        yield state.decode(b"", final=True)


def _definition(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    _supported(json.loads(definition))
    return spark.sparkContext.broadcast(definition)


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and ``ids``: packed little-endian unsigned 32-bit token ids of the whole text.

    A column named like ``ids`` is replaced, all others stay as they are,
    whatever their names.  NULL and empty texts have no ids (empty binary);
    repeated rows are encoded alike; an empty table gives an empty result.  A
    special token's name within a text is that token, as the tokenizer's
    default has it; no other is added.  Very long texts pass in portions; what
    a task holds beyond the row itself does not grow with the text.  There is
    no shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared, name = _definition(spark, tokenizer_path), f"transducer of {tokenizer_path}"

    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = remembered(name, lambda: Encoder(shared.value))
        for batch in batches:
            yield pd.Series([b"".join(encoder(body)) for body in batch], dtype=object)

    encoded.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(ids, F.pandas_udf(encoded, "binary")(F.coalesce(F.col(text), F.lit(""))))


def decode(rows: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``text``: the decoded ``ids``, special tokens included.

    NULL ids count as none and give an empty text; ids beyond the vocabulary
    stop the job; bytes that form no character come out as U+FFFD.
    """
    spark = rows.sparkSession
    small_batches(spark)
    shared, name = _definition(spark, tokenizer_path), f"bytes of {tokenizer_path}"

    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = remembered(name, lambda: Decoder(shared.value))
        for batch in batches:
            runs = (np.frombuffer(packed, "<u4") for packed in batch)
            yield pd.Series(
                ["".join(decoder(run[at : at + RUN] for at in range(0, len(run), RUN))) for run in runs], dtype=object
            )

    decoded.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return rows.withColumn(text, F.pandas_udf(decoded, "string")(F.coalesce(F.col(ids), F.lit(b""))))
