"""Exact top-k inner products by block-at-a-time pruning.

Vectors are ordered so that similar ones stand together, and cut into blocks of
consecutive rows.  A block carries the largest and the smallest value of every
term (dimension) and its rows as a forward index.  For each query the summed
term maxima bound a block's scores; blocks are scored from the highest bound
down until a bound falls below the query's k-th score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import cut_lineage

#: Rows in a block, most rows in a shard (what one task holds), most queries in a group.
BLOCK, SHARD, GROUP = 64, 65_536, 4_096
#: Vectors that attract similar ones when rows are ordered; taken by the hash of their id.
PIVOTS = 64
#: Sums of products below this are exact in floating point.
EXACT = float(1 << 53)


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL, NaN or an infinite value."""
    infinity = F.lit(float("inf"))
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinity)
    )


def _matrix(column, width: int) -> np.ndarray:
    return np.array([np.asarray(v) for v in column], np.int64).reshape(len(column), width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: floating point where sums cannot round, else 64-bit integers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest >= float(1 << 63):
        raise OverflowError("a score would not fit a long")
    return a @ b.T


def _cut(rows: pd.DataFrame, size: int) -> Iterator[tuple]:
    for at in range(0, len(rows), size):
        yield rows.iloc[at : at + size]


def _search(blocks: list[tuple], uids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query, vec_id, score) of the k best rows of the blocks for each query; the query's own row is left out.

    ``blocks`` are (uids, vec_ids, values) with rows by vec_id.
    """
    high = np.array([values.max(0) for _, _, values in blocks])
    low = np.array([values.min(0) for _, _, values in blocks])
    first = np.array([ids.min() for _, ids, _ in blocks])
    bounds = _products(np.maximum(queries, 0), high) + _products(np.minimum(queries, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    none = -np.iinfo(np.int64).max  # its negative is a number, too
    best = np.full((len(queries), k), none)
    names = np.full((len(queries), k), np.iinfo(np.int64).max)
    active = np.arange(len(queries))
    for step in range(len(blocks)):
        which = order[active, step]
        bound = bounds[active, which]
        kth, last = best[active, k - 1], names[active, k - 1]
        # Bounds only fall from here on: a query whose bound is below its k-th score is done.
        goes_on = bound >= kth
        active, which, bound, kth, last = (x[goes_on] for x in (active, which, bound, kth, last))
        if not len(active):
            break
        # At the k-th score itself only smaller ids could still come in.
        worth = (bound > kth) | (first[which] < last)
        chosen, target = active[worth], which[worth]
        by_block = np.argsort(target, kind="stable")
        chosen, target = chosen[by_block], target[by_block]
        edges = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else []
        for i, j in zip(edges, [*edges[1:], len(target)]):
            own, ids, values = blocks[target[i]]
            qs = chosen[i:j]
            scores = _products(queries[qs], values)
            scores[own[None, :] == uids[qs][:, None]] = none
            names_all = np.concatenate([names[qs], np.broadcast_to(ids, scores.shape)], axis=1)
            all_scores = np.concatenate([best[qs], scores], axis=1)
            # Larger scores first, then smaller ids.
            rank = np.lexsort((names_all, -all_scores), axis=1)[:, :k]
            best[qs] = np.take_along_axis(all_scores, rank, 1)
            names[qs] = np.take_along_axis(names_all, rank, 1)
    return [
        (uids[q], names[q, r], best[q, r]) for q in range(len(queries)) for r in range(k) if best[q, r] != none
    ]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row that ``is_query`` selects.

    All rows but the query's own compete; scores are integer inner products of
    the quantised vectors, ties go to the smaller id.  Rows without a key, and
    vectors that are NULL or hold NULL or non-finite values, take no part.
    Only vectors of the same length are compared.  Components so large that a
    score might not fit a long stop the job with an error.  A repeated row is
    another row: it competes, and as a query has results of its own.  Other
    columns are ignored; an empty table gives an empty result.

    Queries are a stated set and meet the rows in blocks of bounded size:
    groups of queries times shards of rows.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"),
        F.size(vector).alias("width"),
        quantised(F.col(vector)).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("uid"),
    )
    rows = cut_lineage(rows)
    # One small row: how many rows and queries there are.
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, math.ceil(asked / GROUP))
    shards = max(1, math.ceil(total / SHARD), math.ceil(partitions / groups))

    # A bounded sample of rows, spread by hash; it decides only the order, never the result.
    sample = rows.orderBy(F.xxhash64("id"), "uid").limit(PIVOTS).select("width", "v").collect()
    pivots = {w: _matrix([r["v"] for r in sample if r["width"] == w], w) for w in {r["width"] for r in sample}}

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = np.zeros(len(batch), np.int64)
            widths = batch["width"].to_numpy()
            for width, heads in pivots.items():
                at = np.flatnonzero(widths == width)
                if len(at):
                    values = _matrix(batch["v"].iloc[at], width).astype(float)
                    near[at] = (values @ heads.astype(float).T).argmax(1)
            yield batch.assign(near=near)

    # Ranges of (length, nearest pivot, id): ids are unique enough to cut through any crowd of similar rows.
    ordered = (
        rows.select("uid", "id", "width", "v")
        .mapInPandas(placed, "uid long, id long, width int, v array<long>, near long")
        .repartitionByRange(shards, "width", "near", "id", "uid")
        .sortWithinPartitions("width", "near", "id", "uid")
        .withColumn("shard", F.spark_partition_id())
    )

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for (shard, width), part in batch.groupby(["shard", "width"], sort=False):
                for block in _cut(part, BLOCK):
                    values = _matrix(block["v"], width)
                    out.append(
                        (shard, width, block["uid"].to_numpy("<i8").tobytes(), block["id"].to_numpy("<i8").tobytes(),
                         values.astype("<i8").tobytes())
                    )
            yield pd.DataFrame(out, columns=["shard", "width", "uids", "ids", "rows"])

    blocks = ordered.mapInPandas(blocked, "shard int, width int, uids binary, ids binary, rows binary")
    blocks = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    questions = rows.filter("asks").select(
        "uid", "width", "v", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("group")
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def searched(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for width, part in asked.groupby("width"):
            held = [
                (np.frombuffer(r.uids, "<i8"), np.frombuffer(r.ids, "<i8"),
                 np.frombuffer(r.rows, "<i8").reshape(-1, width) if width else np.zeros((len(r.ids) // 8, 0), np.int64))
                for r in block[block["width"] == width].itertuples(index=False)
            ]
            if held:
                out += _search(held, part["uid"].to_numpy(np.int64), _matrix(part["v"], width), k)
        return pd.DataFrame(out, columns=["uid", "vec", "score"])

    keys = ("shard", "group", "width")
    found = (
        blocks.groupBy(*keys)
        .cogroup(questions.groupBy(*keys))
        .applyInPandas(searched, "uid long, vec long, score long")
    )
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "vec")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    named = rows.filter("asks").select("uid", F.col("id").alias("query_id"))
    kind = vectors.schema[key].dataType
    return ranked.join(named, "uid").select(
        F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("vec").cast(kind).alias("vec_id"), "score"
    )
