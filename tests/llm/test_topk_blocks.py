import math
import random

from pyspark.sql import functions as F

from tidemark.llm import topk_blocks
from tidemark.llm.topk_blocks import top_k

SCHEMA = "vec_id long, embedding array<float>, uid long, shard int, group int, width int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, 1, 1, 1, "v") for k, v in rows], SCHEMA).repartition(3)


def plain(rows, asks, k=5):
    ok = [
        (i, key, [math.floor(256 * x) for x in v])
        for i, (key, v) in enumerate(rows)
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, key, q in ok:
        if asks(key):
            scores = sorted((-sum(a * b for a, b in zip(q, v)), c) for j, c, v in ok if j != i and len(v) == len(q))
            out += [(key, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def result(found):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_blocks, "BLOCK", 8)
    monkeypatch.setattr(topk_blocks, "SHARD", 100)
    monkeypatch.setattr(topk_blocks, "GROUP", 4)
    pick = random.Random(1)
    centres = [[pick.choice([-0.5, 0.5, 0.25]) for _ in range(6)] for _ in range(5)]
    # Multiples of 1/256 are the same in single and double precision.
    rows = [(i, [c + pick.randrange(-40, 40) / 256 for c in pick.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(10, rows[10][1])]
    found = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=5)
    assert result(found) == plain(rows, lambda k: k % 10 == 0)


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (5, [0.5, 0.25]), (6, [0.5]), (7, []), (8, []), (9, [-1.0, 3.0]), (10, [2.0**20, 2.0**20]), (11, [2.0**20, -(2.0**20)]),
    ]
    assert result(top_k(frame(spark, rows), F.lit(True))) == plain(rows, lambda k: True)
    assert top_k(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert top_k(frame(spark, rows), F.lit(False)).count() == 0
    assert result(top_k(frame(spark, rows[:1]), F.lit(True))) == []
