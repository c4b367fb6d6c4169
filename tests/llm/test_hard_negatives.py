import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.fixtures import plan_of
from tidemark.llm import hard_negatives
from tidemark.llm.hard_negatives import heap_rows, mine_hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, shard int, group int, width int, v string, place int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, y, 1, 1, 1, 1, "v", 1, 1) for k, v, y in rows], SCHEMA).repartition(3)


def plain(rows, asks, k=5):
    ok = [
        (i, key, [math.floor(256 * x) for x in v], y)
        for i, (key, v, y) in enumerate(rows)
        if key is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, key, q, y in ok:
        if not asks(key):
            continue
        others = [(-sum(a * b for a, b in zip(q, v)), c, z) for j, c, v, z in ok if j != i and len(v) == len(q)]
        others.sort(key=lambda o: o[:2])
        for score, positive, _ in [o for o in others if o[2] == y][:k]:
            window = [o for o in others if o[2] != y and 80 * -score <= 100 * -o[0] <= 100 * -score]
            out += [(key, positive, r + 1, c, -score, -s) for r, (s, c, _) in enumerate(window[:k])]
    return sorted(out)


def result(found):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in found.collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (40, 40, 40), (65, 33, 129), (5, 0, 3), (0, 20, 20), (64, 64, 1)])
def test_strassen_is_exact(shape, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 4)
    pick = np.random.default_rng(1)
    a, b = pick.integers(-(1 << 25), 1 << 25, shape[:2]), pick.integers(-(1 << 25), 1 << 25, shape[1:])
    assert (strassen(a, b) == a.astype(object) @ b.astype(object)).all()


def test_sums_that_overflow_on_the_way_do_no_harm(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 1)
    big = 1 << 62
    a = np.array([[big, 1], [big, big]], np.int64)
    b = np.array([[1, 1], [0, 1]], np.int64)
    assert strassen(a, b).tolist() == [[big, big + 1], [big, -(1 << 63)]]


def test_heaps_keep_the_first_of_equal_scores():
    scores = np.array([[3, 5, 5, 5, 1], [2, 2, 2, 2, 2], [9, 8, 7, 6, 5]])
    allowed = np.array([[1, 1, 0, 1, 1], [0, 1, 1, 1, 1], [0, 0, 0, 0, 1]], bool)
    rows, columns = heap_rows(scores, allowed, 2)
    assert list(zip(rows.tolist(), columns.tolist())) == [(0, 1), (0, 3), (1, 1), (1, 2), (2, 4)]


@pytest.mark.parametrize("width", [6, 40])
def test_equals_brute_force(spark, monkeypatch, width):
    for name, size in (("BLOCK", 16), ("SHARD", 50), ("GROUP", 8), ("STRIP", 3), ("LEAF", 2)):
        monkeypatch.setattr(hard_negatives, name, size)
    pick = random.Random(width)
    centres = [[pick.choice([-0.5, 0.5, 0.25]) for _ in range(width)] for _ in range(5)]
    # Multiples of 1/256 are the same in single and double precision.
    rows = [(i, [c + pick.randrange(-60, 60) / 256 for c in pick.choice(centres)], i % 3) for i in range(300)]
    # A third of all rows is one vector, under several labels.
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(150)] + [rows[10], rows[11]]
    got = result(mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0))
    assert got and got == plain(rows, lambda k: k % 10 == 0)


def test_labels_from_an_expression(spark):
    rows = [(i, [1.0, i / 256], i % 2) for i in range(20)]
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 2).otherwise(F.col("label"))
    got = result(mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0, label=turned))
    changed = [(k, v, (y + 1) % 2 if k % 7 == 0 else y) for k, v, y in rows]
    assert got == plain(changed, lambda k: k % 5 == 0)


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
        (None, [1.0, 1.0], 0), (5, [0.5, 0.25], 1), (6, [0.5], 0), (7, [], 0), (8, [], 1), (18, [], 0), (9, [-1.0, 3.0], 0),
        (10, [4.0, 4.0], 1), (11, [4.0, -4.0], 0), (12, [1.0, 1.9], None), (13, [1.0, 1.9], 1), (13, [1.0, 1.9], 1), (0, [1.0, 2.0], 0),
        (14, [0.0, 0.0], 0), (15, [0.0, 0.0], 1), (16, [-1.0, -2.0], 0),
    ]
    assert result(mine_hard_negatives(frame(spark, rows), F.lit(True))) == plain(rows, lambda k: True)
    assert mine_hard_negatives(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert mine_hard_negatives(frame(spark, rows), F.lit(None).cast("boolean")).count() == 0
    assert result(mine_hard_negatives(frame(spark, rows[:1]), F.lit(True))) == []


def test_vectors_whose_scores_might_not_fit_are_refused(spark):
    with pytest.raises(Exception, match="might not fit"):
        mine_hard_negatives(frame(spark, [(0, [1e30, 1.0], 0), (1, [1.0, 1.0], 0)]), F.lit(True)).collect()


def test_heaps_shrink_before_the_shuffle(spark):
    found = mine_hard_negatives(frame(spark, [(i, [1.0, i / 256], i % 2) for i in range(20)]), F.lit(True))
    assert "WindowGroupLimit" in plan_of(found)
