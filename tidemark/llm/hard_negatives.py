"""Hard negatives by Strassen products of int64 tiles.

Anchors are a stated set and meet all rows in tiles of bounded size.  A tile's
scores are one matrix product, worked out by Strassen's recursion with zero
padding and integer additions only.  Products run in the ring of 64-bit
integers, so sums that overflow on the way change nothing as long as the score
itself fits, which is checked.  Each tile keeps a bounded heap per anchor
(positives) or per anchor and positive (the window of negatives); heaps of
tiles merge into one by their best rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.worker import small_batches
from tidemark.session import cut_lineage

#: Rows in a packed block, most candidates in a shard, most anchors in a group, anchors scored at once.
BLOCK, SHARD, GROUP, STRIP = 4_096, 65_536, 4_096, 256
#: A product with a side of at most this many is worked out directly.
LEAF = 16
#: Scores stay below this, so that a hundred times a score fits a long.
LIMIT = float(1 << 56)
NONE = np.iinfo(np.int64).min


def _even(tile: np.ndarray) -> np.ndarray:
    """A tile with even sides: a row or column of zeros is put to an odd one."""
    return np.pad(tile, [(0, side & 1) for side in tile.shape]) if any(side & 1 for side in tile.shape) else tile


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two int64 tiles, modulo 2**64: seven products of halves instead of eight."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= LEAF:
        return a @ b
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


def heap_rows(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed scores of each row; of equal ones the first columns."""
    held = np.where(allowed, scores, NONE)
    if held.shape[1] > k:
        least = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k, None]
        above, level = held > least, held == least
        level &= np.cumsum(level, axis=1) <= k - above.sum(1, keepdims=True)
        allowed = (above | level) & allowed
    return np.nonzero(allowed)


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL, NaN or an infinite value."""
    infinity = F.lit(float("inf"))
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinity)
    )


def _matrix(column, width: int) -> np.ndarray:
    """floor(256 * x) of each component as int64; a vector whose scores might not fit is refused."""
    values = np.floor(256.0 * np.array([np.asarray(v, np.float64) for v in column]).reshape(len(column), width))
    if len(values) and np.abs(values).max(initial=0) * math.sqrt(max(width, 1)) >= math.sqrt(LIMIT):
        raise ValueError("a component is 2**20 / sqrt(width) or larger: scores might not fit the result's long columns")
    return values.astype(np.int64)


def _unpacked(blocks: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """Ids, row numbers, labels and values of a shard, rows by id."""
    ids, uids, labels = (
        np.concatenate([np.frombuffer(part, "<i8") for part in blocks[name]]) for name in ("ids", "uids", "labels")
    )
    values = np.concatenate([np.frombuffer(part, "<i8").reshape(-1, width) if width else np.zeros((len(i) // 8, 0), np.int64)
                             for part, i in zip(blocks["rows"], blocks["ids"])])
    order = np.lexsort((uids, ids))
    return ids[order], uids[order], labels[order], np.ascontiguousarray(values[order].T)


def _tiles(anchors: pd.DataFrame, shard: tuple, width: int) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Scores of a strip of anchors with a block of candidates, tile by tile."""
    heads = np.frombuffer(b"".join(anchors["row"]), "<i8").reshape(len(anchors), width)
    for at in range(0, len(anchors), STRIP):
        for start in range(0, len(shard[0]), BLOCK):
            strip, block = slice(at, at + STRIP), slice(start, start + BLOCK)
            yield strip, block, strassen(heads[strip], shard[3][:, block])


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    A row's score is its integer inner product with the anchor, components
    taken as floor(256 * x); higher ones come first, then smaller ids.  An
    anchor's positives are its first other rows of the same label; for each
    positive, the first rows of another label are returned whose score lies
    between ``low`` and ``high`` percent of the positive's.  An anchor without
    positives, or a positive without rows in its window, gives no rows.

    Rows without a key, a label or a vector, and vectors holding NULL or
    non-finite values, take no part.  Only vectors of the same length are
    compared.  A repeated row is another row: it competes, and as an anchor has
    results of its own.  A component of 2**20 / sqrt(width) or more stops the job
    with an error, as a hundred times such a score might not fit a long.  Other
    columns are ignored, whatever their names; an empty table gives an empty
    result.

    Every task holds one shard of candidates and one group of anchors.  Both
    are sent to the tiles they belong to, blocks of rows in packed form: a
    candidate is sent once for some four thousand anchors, which is a small
    part of scoring it against them.
    """
    if not 0 <= low <= high <= 120:
        raise ValueError("the window lies between 0 and 120 percent, low before high")
    spark = vectors.sparkSession
    small_batches(spark)
    by_label = F.col(label) if isinstance(label, str) else label
    rows = cut_lineage(
        vectors.select(
            F.col(key).cast("long").alias("id"),
            by_label.cast("long").alias("label"),
            F.col(vector).alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        )
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
        .select("id", "label", "v", "asks", F.size("v").alias("width"), F.monotonically_increasing_id().alias("uid"))
    )
    # One small row: how many rows and anchors there are.
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, math.ceil(asked / GROUP))
    shards = max(1, math.ceil(total / SHARD), math.ceil(min(partitions, total / BLOCK) / groups))
    most = max(1, min(BLOCK, math.ceil(total / shards)))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby("width", sort=False):
                for at in range(0, len(part), most):
                    block = part.iloc[at : at + most]
                    numbers = [block[name].to_numpy("<i8").tobytes() for name in ("id", "uid", "label")]
                    values = _matrix(block["v"], width).astype("<i8").tobytes()
                    yield pd.DataFrame(
                        [(width, int(block["uid"].iloc[0]), *numbers, values)],
                        columns=["width", "first", "ids", "uids", "labels", "rows"],
                    )

    def quantised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby("width", sort=False):
                values = [row.astype("<i8").tobytes() for row in _matrix(part["v"], width)]
                yield part[["uid", "id", "label", "width"]].assign(row=values)

    blocks = rows.mapInPandas(packed, "width int, first long, ids binary, uids binary, labels binary, rows binary")
    blocks = blocks.select(
        "*",
        F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    heads = rows.filter("asks").mapInPandas(quantised, "uid long, id long, label long, width int, row binary")
    heads = cut_lineage(heads.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")))
    tile = ("shard", "group", "width")

    def everywhere(anchors: DataFrame) -> DataFrame:
        return anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).groupBy(*tile)

    def nearest(block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        for width, part in anchors.groupby("width"):
            held = block[block["width"] == width]
            if not len(held):
                continue
            shard = ids, uids, labels, _ = _unpacked(held, width)
            mine, marks = part["uid"].to_numpy(), part["label"].to_numpy()
            for strip, of, scores in _tiles(part, shard, width):
                same = (labels[of] == marks[strip, None]) & (uids[of] != mine[strip, None])
                i, j = heap_rows(scores, same, positives)
                found.append((mine[strip][i], ids[of][j], uids[of][j], scores[i, j]))
        return _frame(found, ["uid", "positive_id", "other", "positive_score"])

    def in_window(block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        for width, part in anchors.groupby("width"):
            held = block[block["width"] == width]
            if not len(held):
                continue
            shard = ids, uids, labels, _ = _unpacked(held, width)
            mine, marks = part["uid"].to_numpy(), part["label"].to_numpy()
            levels = np.full((len(part), positives), NONE)
            for i, scores in enumerate(part["levels"]):
                levels[i, : len(scores)] = scores
            for strip, of, scores in _tiles(part, shard, width):
                other = labels[of] != marks[strip, None]
                hundredfold = 100 * scores
                for place in range(positives):
                    level = levels[strip, place, None]
                    asks = np.flatnonzero(level[:, 0] != NONE)
                    if not len(asks):
                        continue
                    fits = other[asks] & (low * level[asks] <= hundredfold[asks]) & (hundredfold[asks] <= high * level[asks])
                    i, j = heap_rows(scores[asks], fits, negatives)
                    i = asks[i]
                    found.append((mine[strip][i], np.full(len(i), place + 1), ids[of][j], uids[of][j], scores[i, j]))
        return _frame(found, ["uid", "place", "negative_id", "other", "negative_score"])

    def best(heaps: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
        """Heaps of tiles merged: map tasks keep ``k`` rows each before the shuffle."""
        first = Window.partitionBy(*by).orderBy(F.desc(score), name, "other")
        place = "place" if "place" not in by else "rank"
        return heaps.withColumn(place, F.row_number().over(first)).filter(F.col(place) <= k).drop("other")

    schema = "uid long, positive_id long, other long, positive_score long"
    near = blocks.groupBy(*tile).cogroup(everywhere(heads)).applyInPandas(nearest, schema)
    chosen = cut_lineage(best(near, ["uid"], "positive_score", "positive_id", positives))
    # At most ``positives`` scores per anchor, in their order.
    levels = chosen.groupBy("uid").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("levels"))
    schema = "uid long, place int, negative_id long, other long, negative_score long"
    inside = blocks.groupBy(*tile).cogroup(everywhere(heads.join(levels, "uid"))).applyInPandas(in_window, schema)
    ranked = best(inside, ["uid", "place"], "negative_score", "negative_id", negatives)
    kind = vectors.schema[key].dataType
    named = heads.select("uid", F.col("id").alias("anchor_id"))
    return (
        ranked.join(chosen, ["uid", "place"])
        .join(named, "uid")
        .select(
            F.col("anchor_id").cast(kind).alias("anchor_id"),
            F.col("positive_id").cast(kind).alias("positive_id"),
            "rank",
            F.col("negative_id").cast(kind).alias("negative_id"),
            "positive_score",
            "negative_score",
        )
    )


def _frame(found: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows found in all tiles."""
    if not found:
        return pd.DataFrame({name: np.empty(0, np.int64) for name in names})
    return pd.DataFrame({name: np.concatenate(parts) for name, parts in zip(names, zip(*found))})
