"""Exact substring deduplication by fixed-block anchors.

A repeat of 13 words holds at least one whole block of a grid of 7-word blocks,
wherever it lies.  So only the non-overlapping blocks of each document are
indexed, every rolling 7-word window is probed against them, and hits are
extended: all 13-word windows around a hit are compared by 96-bit digests, and
runs of repeated windows cover the maximal repeats.

Documents are dealt into chunks once (a shuffle of the texts, reused by all
three passes).  What chunks exchange are sorted, packed hashes: each chunk sends
a hash once, however often it holds it, so a passage shared by a third of the
documents is no hot key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import FIRST, SECOND, window_hashes, word_hashes

#: Bits kept of an anchor hash; a false match costs a comparison, never a wrong result.
ANCHOR_BITS = 46
#: Text in a chunk, and hashes that meet in a bucket, in bytes of text.
CHUNK_BYTES, BUCKET_BYTES = 16 << 20, 64 << 20
#: Stands for a NULL key: later than all others.
LAST = np.iinfo(np.int64).max


class Words:
    """The words of the documents of one chunk, one after the other."""

    def __init__(self, texts, keys):
        self.words = [text.encode("utf-8", "surrogatepass").split() for text in texts]
        self.counts = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.starts = np.cumsum(self.counts) - self.counts
        self.hashes = (
            np.concatenate([word_hashes(w) for w in self.words]) if len(self.words) else np.empty(0, np.uint64)
        )
        self.keys = np.array([LAST if key is None else int(key) for key in keys], np.int64)
        # For each word: its place in its document and the words from there on.
        self.doc = np.repeat(np.arange(len(self.words)), self.counts)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.starts, self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place

    def windows(self, size: int, factors: np.ndarray = FIRST) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window inside a document."""
        hashes = window_hashes(self.hashes, size, factors)
        inside = np.flatnonzero(self.left[: len(hashes)] >= size)
        return inside, hashes[inside]


def _planes(values: np.ndarray, width: int) -> bytes:
    """Little-endian bytes, plane by plane: sorted values compress well that way."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplaned(data: bytes, width: int) -> np.ndarray:
    count = len(data) // width
    full = np.zeros((count, 8), np.uint8)
    full[:, :width] = np.frombuffer(data, np.uint8).reshape(width, count).T
    return full.view("<u8").reshape(-1).astype(np.uint64)


def _bucket(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Buckets are ranges of hash values, so they are slices of a sorted array."""
    return ((hashes >> np.uint64(max(bits - 32, 0))) * np.uint64(buckets) >> np.uint64(min(bits, 32))).astype(np.int64)


def _slices(sorted_buckets: np.ndarray):
    if len(sorted_buckets):
        which, first = np.unique(sorted_buckets, return_index=True)
        yield from zip(which.tolist(), first.tolist(), [*first[1:].tolist(), len(sorted_buckets)])


def _anchors(words: Words, block: int) -> tuple[np.ndarray, np.ndarray]:
    first, hashes = words.windows(block)
    return first, hashes >> np.uint64(64 - ANCHOR_BITS)


def _probe(words: Words, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct window hashes of a chunk, each with two flags: held by a grid block, held more than once."""
    first, hashes = _anchors(words, block)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    grid = (words.place[first] % block == 0)[order]
    if not len(hashes):
        return hashes, hashes
    edge = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    count = np.diff(np.r_[edge, len(hashes)])
    flags = np.logical_or.reduceat(grid, edge).astype(np.uint64) | (count > 1).astype(np.uint64) << np.uint64(1)
    return hashes[edge], flags


def _repeated(words: Words, block: int, size: int, hits: np.ndarray) -> np.ndarray:
    """First words of the ``size``-word windows around the anchors in ``hits`` (sorted)."""
    first, hashes = _anchors(words, block)
    if not len(hits) or not len(first):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(hits, hashes), len(hits) - 1)
    hit = np.zeros(len(words.hashes) + 1, np.int64)
    hit[first[hits[at] == hashes] + 1] = 1
    total = np.cumsum(hit)
    starts = np.flatnonzero(words.left >= size)
    return starts[total[starts + size - block + 1] > total[starts]]


#: 96-bit digest of a window.
DIGEST = np.dtype([("a", "<u8"), ("b", "<u4")])


def _digests(words: Words, starts: np.ndarray, size: int) -> np.ndarray:
    pairs = np.empty(len(starts), DIGEST)
    if len(starts):
        pairs["a"] = window_hashes(words.hashes, size, FIRST)[starts]
        pairs["b"] = (window_hashes(words.hashes, size, SECOND)[starts] >> np.uint64(32)).astype(np.uint32)
    return pairs


def _packed(pairs: np.ndarray, keys: np.ndarray) -> bytes:
    """Digests and keys, plane by plane."""
    return _planes(pairs["a"], 8) + _planes(pairs["b"], 4) + _planes(keys, 8)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    count = len(data) // 20
    pairs = np.empty(count, DIGEST)
    pairs["a"] = _unplaned(data[: 8 * count], 8)
    pairs["b"] = _unplaned(data[8 * count : 12 * count], 4)
    return pairs, _unplaned(data[12 * count :], 8).astype(np.int64)


def remove_repeats(
    docs: DataFrame, size: int = 13, block: int = 7, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The key, ``n_words``, ``n_removed`` and ``kept_text`` of every row.

    A word goes if it lies in a window of ``size`` words that also starts in a
    document with a smaller key; windows are those of the input.  ``kept_text``
    holds the other words, joined by one space.

    The key is an integer.  Rows without one come after all others: they lose
    repeats and cause none.  Repeated rows and rows that share a key do not
    shorten each other.  NULL and empty texts have no words; other columns are
    ignored; an empty table gives an empty result.
    """
    if not 0 < block <= (size + 1) // 2:
        raise ValueError("a window of `size` words must hold a whole block wherever it starts")
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(4 * partitions, total // CHUNK_BYTES + 1)
    buckets = max(partitions, total // BUCKET_BYTES + 1)

    texts = docs.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(chunks)).cast("long").alias("chunk"),
    )

    def read(frame: pd.DataFrame) -> Words:
        keys = [None if pd.isna(k) else k for k in frame["key"].astype("Int64")] if len(frame) else []
        return Words(frame["text"], keys)

    def probe(frame: pd.DataFrame) -> pd.DataFrame:
        hashes, flags = _probe(read(frame), block)
        packed = hashes << np.uint64(2) | flags
        rows = [
            (b, frame["chunk"].iloc[0], _planes(packed[i:j], 6))
            for b, i, j in _slices(_bucket(hashes, ANCHOR_BITS, buckets))
        ]
        return pd.DataFrame(rows, columns=["bucket", "chunk", "data"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        """Anchors held by a grid block and by something else, returned to the chunks that hold them."""
        parts = [_unplaned(data, 6) for data in frame["data"]]
        packed = np.concatenate(parts)
        hashes = packed >> np.uint64(2)
        order = np.argsort(hashes, kind="stable")
        sorted_hashes = hashes[order]
        edge = np.flatnonzero(np.r_[True, sorted_hashes[1:] != sorted_hashes[:-1]])
        flags = np.bitwise_or.reduceat(packed[order] & np.uint64(3), edge)
        count = np.diff(np.r_[edge, len(hashes)])
        good = sorted_hashes[edge][(flags & np.uint64(1) > 0) & ((count > 1) | (flags & np.uint64(2) > 0))]
        rows = []
        for chunk, part in zip(frame["chunk"], parts):
            own = part >> np.uint64(2)
            shared = own[np.isin(own, good, assume_unique=True)]
            if len(shared):
                rows.append((chunk, _planes(shared, 6)))
        return pd.DataFrame(rows, columns=["chunk", "data"])

    def extend(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(frame) or not len(found):
            return pd.DataFrame([], columns=["bucket", "chunk", "data", "several"])
        words = read(frame)
        hits = np.sort(np.concatenate([_unplaned(data, 6) for data in found["data"]]))
        starts = _repeated(words, block, size, hits)
        pairs = _digests(words, starts, size)
        keys = words.keys[words.doc[starts]]
        distinct, back = np.unique(pairs, return_inverse=True)
        least = np.full(len(distinct), LAST, np.int64)
        most = np.full(len(distinct), np.iinfo(np.int64).min, np.int64)
        np.minimum.at(least, back, keys)
        np.maximum.at(most, back, keys)
        rows = [
            (b, frame["chunk"].iloc[0], _packed(distinct[i:j], least[i:j]), np.packbits((least < most)[i:j]).tobytes())
            for b, i, j in _slices(_bucket(distinct["a"], 64, buckets))
        ]
        return pd.DataFrame(rows, columns=["bucket", "chunk", "data", "several"])

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        """The smallest key of each window, returned to the chunks where a larger key holds it."""
        parts = [_unpacked(data) for data in frame["data"]]
        distinct, back = np.unique(np.concatenate([pairs for pairs, _ in parts]), return_inverse=True)
        least = np.full(len(distinct), LAST, np.int64)
        np.minimum.at(least, back, np.concatenate([keys for _, keys in parts]))
        rows, at = [], 0
        for chunk, (pairs, keys), several in zip(frame["chunk"], parts, frame["several"]):
            own = back[at : at + len(pairs)]
            at += len(pairs)
            many = np.unpackbits(np.frombuffer(several, np.uint8), count=len(pairs)).astype(bool)
            wanted = many | (least[own] < keys)
            if wanted.any():
                rows.append((chunk, _packed(pairs[wanted], least[own[wanted]])))
        return pd.DataFrame(rows, columns=["chunk", "data"])

    def remove(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame([], columns=["key", "n_words", "n_removed", "kept_text"])
        words = read(frame)
        gone = np.zeros(len(words.hashes) + 1, np.int64)
        if len(found):
            parts = [_unpacked(data) for data in found["data"]]
            known = np.concatenate([pairs for pairs, _ in parts])
            least = np.concatenate([keys for _, keys in parts])
            order = np.argsort(known["a"], kind="stable")
            known, least = known[order], least[order]
            starts = np.flatnonzero(words.left >= size)
            first = window_hashes(words.hashes, size, FIRST)[starts]
            # Few windows are known: look them up by the first half of their digests.
            starts = starts[np.isin(first, known["a"])]
            pairs = _digests(words, starts, size)
            merged, back = np.unique(np.concatenate([known, pairs]), return_inverse=True)
            smallest = np.full(len(merged), LAST, np.int64)
            np.minimum.at(smallest, back[: len(known)], least)
            starts = starts[smallest[back[len(known) :]] < words.keys[words.doc[starts]]]
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + size, -1)
        covered = np.cumsum(gone)[:-1] > 0
        rows = []
        for (key_, held, start) in zip(frame["key"].astype("Int64"), words.words, words.starts.tolist()):
            mask = covered[start : start + len(held)]
            removed = int(mask.sum())
            kept = [w for w, m in zip(held, mask.tolist()) if not m] if removed else held
            rows.append((key_, len(held), removed, b" ".join(kept).decode("utf-8", "surrogatepass")))
        out = pd.DataFrame(rows, columns=["key", "n_words", "n_removed", "kept_text"])
        return out.astype({"key": "Int64"})

    by_chunk = texts.groupBy("chunk")
    probes = by_chunk.applyInPandas(probe, "bucket long, chunk long, data binary")
    anchors = probes.groupBy("bucket").applyInPandas(meet, "chunk long, data binary")
    windows = by_chunk.cogroup(anchors.groupBy("chunk")).applyInPandas(
        extend, "bucket long, chunk long, data binary, several binary"
    )
    owners = windows.groupBy("bucket").applyInPandas(settle, "chunk long, data binary")
    result = by_chunk.cogroup(owners.groupBy("chunk")).applyInPandas(
        remove, "key long, n_words long, n_removed long, kept_text string"
    )
    return result.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_words", "n_removed", "kept_text")
