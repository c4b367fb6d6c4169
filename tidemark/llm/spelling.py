"""Spelling variants by dense prefix-suffix tiling.

Words become rows of padded code-point matrices.  Two words differ by one
inserted, deleted or replaced code point exactly if they differ and their
common prefix and common suffix together are as long as the longer one less
one, so pairs are settled by counting equal code points from both ends.

Which blocks meet: one of the two, prefix or suffix, is half of that length or
more.  So words are grouped by the first half and by the last half, for either
word being the longer one, and only blocks of a group are compared.  Large
groups are cut into blocks, and every two blocks of one are a tile of their
own.  Only links leave a tile.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import LOWER, UPPER
from tidemark.llm.worker import small_batches
from tidemark.session import cut_lineage

#: Letters of words (fixed value): Latin ones, and all of U+00C0 to U+00FF.
RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWERED = str.maketrans(UPPER, LOWER)
#: Different words counted by a task before they are handed on.
HELD = 200_000
#: Most words in a block of a group; code points handed to a task at a time; code points of pairs compared at a time.
BLOCK, BIN, PAIRS = 512, 200_000, 1 << 22


def _text(values: Iterable[str]) -> pd.Series:
    """Strings as plain objects: Arrow may hold pandas' own kind in several pieces, which Spark does not take."""
    return pd.Series(list(values), dtype=object)


def word_counts(docs: DataFrame, noise: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) over all texts: runs of letters, A-Z lower-cased.

    Where ``noise`` divides the checksum of "key:run", one code point of the
    run, picked by the checksum, is left out (planted misspellings; 0 for none).
    Each task counts before the shuffle.
    """
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, body in zip(batch["k"], batch["t"]):
                seed = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(RUNS.findall(body)).items():
                    if not run.islower():
                        run = run.translate(LOWERED)
                    # The same run of a document always comes out the same.
                    if noise and (drawn := zlib.crc32(run.encode(), seed)) % noise == 0:
                        at = drawn % len(run)
                        run = run[:at] + run[at + 1 :]
                    held[run] += n
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": _text(held), "n": list(held.values())})
                    held.clear()
        yield pd.DataFrame({"word": _text(held), "n": list(held.values())})

    # The key travels as text: pandas would turn a nullable number into a float.
    texts = docs.filter(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t")
    )
    return texts.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and code points padded with zeros behind and (for suffixes) in front."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=0))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.arange(width) < lengths[:, None]
    front, back = np.zeros((2, len(words), width), np.uint32)
    front[inside] = flat
    back[inside[:, ::-1]] = flat
    return lengths, front, back[:, ::-1]


def common(rows: np.ndarray, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Equal code points from the first column on; padding does not count."""
    apart = rows[i] != rows[j]
    return np.minimum(np.where(apart.any(1), apart.argmax(1), rows.shape[1]), least)


def single_edits(lengths, front, back, i, j) -> tuple[np.ndarray, np.ndarray]:
    """Whether rows ``i`` and ``j`` differ by one edit, and the length of their common prefix."""
    least, longer = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
    prefix = common(front, i, j, least)
    suffix = common(back, i, j, least)
    # Equal words have both in full; "aa" and "aaa" share more than the shorter one holds.
    near = (longer - least <= 1) & (prefix + suffix >= longer - 1) & ~((prefix == longer) & (least == longer))
    return near, prefix


def _pairs(starts: np.ndarray, second: np.ndarray, two: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within each tile, about ``most`` at a time.

    Rows are sorted by tile and block; ``starts`` are the tiles' first rows and
    the number of rows.  A tile of one block compares it with itself, a tile of
    ``two`` blocks each row of the first with each row of the ``second``.
    """
    sizes = np.diff(starts)
    at, end = np.arange(starts[-1]), np.repeat(starts[1:], sizes)
    firsts = np.add.reduceat((~second).astype(np.int64), starts[:-1])
    begin = np.where(two, np.repeat(starts[:-1] + firsts, sizes), at + 1)
    many = np.where(second, 0, end - begin)
    total = np.cumsum(many)
    low = 0
    while low < len(at):
        # Rows of which the pairs fill a portion, one row at least.
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + most, "right")))
        n = many[low:high]
        i = np.repeat(at[low:high], n)
        j = np.repeat(begin[low:high] - np.cumsum(n) + n, n) + np.arange(n.sum())
        if len(i):
            yield i, j
        low = high


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two different words of ``words`` (word, n) one edit apart, in both directions."""
    spark = words.sparkSession
    small_batches(spark)
    length = F.length("word")
    keyed = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    half = F.floor(F.col("longer") / 2).cast("int")
    side = F.when(F.col("side") == 0, F.substring("word", F.lit(1), half)).otherwise(F.right(F.col("word"), half))
    keyed = keyed.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("half", side)
    group = ["longer", "side", "half"]
    # How many blocks a group has; most groups are one.
    sizes = keyed.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sizes = sizes.filter("blocks > 1")
    cut = keyed.join(sizes, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    # Every two blocks of a group meet in one tile; a single block meets itself.
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = cut.withColumn("partner", partner).select(
        "word",
        "n",
        "longer",
        "side",
        "block",
        F.xxhash64(*group).alias("half"),
        F.least("block", "partner").alias("one"),
        F.greatest("block", "partner").alias("other"),
    )
    tiles = cut_lineage(tiles)
    letters = tiles.agg(F.sum(F.length("word"))).scalar()
    names = ["longer", "side", "half", "one", "other"]
    bins = F.greatest(F.lit(1), F.ceil(F.coalesce(letters, F.lit(0)) / BIN))
    tiles = tiles.withColumn("bin", F.pmod(F.xxhash64(*names), bins))

    def linked(part: pd.DataFrame) -> pd.DataFrame:
        # Words of about one length at a time, as rows are as wide as the longest.
        size = np.log2(part["longer"].to_numpy()).astype(int)
        found = [_links(words.sort_values([*names, "block"], ignore_index=True)) for _, words in part.groupby(size)]
        return pd.concat(found)

    return tiles.groupBy("bin").applyInPandas(linked, "word string, n long, near string, near_n long")


def _links(part: pd.DataFrame) -> pd.DataFrame:
    """Links within the tiles of ``part``, both directions; rows are sorted by tile and block."""
    keys = part[["longer", "side", "half", "one", "other"]].to_numpy(np.int64)
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1), True])
    lengths, front, back = code_points(part["word"].tolist())
    longer, side = keys[:, 0], keys[:, 1]
    found = []
    two = keys[:, 3] != keys[:, 4]
    second = two & (part["block"].to_numpy(np.int64) == keys[:, 4])
    for i, j in _pairs(starts, second, two, max(1, PAIRS // max(front.shape[1], 1))):
        # The longer one has the length that the group stands for.
        fits = np.maximum(lengths[i], lengths[j]) == longer[i]
        i, j = i[fits], j[fits]
        near, prefix = single_edits(lengths, front, back, i, j)
        # A pair that meets by both halves is told by the first one.
        near &= (prefix >= longer[i] // 2) == (side[i] == 0)
        found += [np.stack([i[near], j[near]]), np.stack([j[near], i[near]])]
    i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    word, n = part["word"].to_numpy(object), part["n"].to_numpy(np.int64)
    return pd.DataFrame({"word": _text(word[i]), "n": n[i], "near": _text(word[j]), "near_n": n[j]})


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): each word's form, its form's form and so on to the last.

    ``forms`` (word, form) must hold no circle.  Every round doubles the steps
    taken, and is written to the shared folder.
    """
    roots = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(ahead, "root", "left")
        moved = cut_lineage(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return roots


def spelling_variants(
    docs: DataFrame,
    least_length: int = 5,
    least_count: int = 3,
    ratio: int = 2,
    noise: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    Words have ``least_length`` code points or more and occur ``least_count``
    times or more (``n``).  Two are near if one inserted, deleted or replaced
    code point makes one of the other; ``n_near`` counts a word's near ones.
    Its form is the near word that occurs most often (ties: the smallest in
    code-point order), if that has ``ratio`` (2 or more) times its count or more,
    else NULL; ``root`` follows forms to the last, and is the word itself
    without any.  Forms' counts grow by ``ratio``, so there is no circle.

    NULL texts have no words; a NULL key counts as empty text in the checksum;
    repeated rows count each; other columns are ignored; very long texts are
    counted whole; an empty table gives an empty result.
    """
    if ratio < 2 or least_length < 2:
        raise ValueError("ratio and least_length are 2 or more")
    counted = word_counts(docs, noise, key, text)
    words = cut_lineage(counted.filter((F.length("word") >= least_length) & (F.col("n") >= least_count)))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    found = cut_lineage(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(form_n >= ratio * F.col("n"), F.col("best.form")).alias("form"),
            F.when(form_n >= ratio * F.col("n"), form_n).alias("form_n"),
        )
    )
    roots = follow(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
