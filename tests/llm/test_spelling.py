import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import awkward_docs, awkward_texts, no_docs
from tidemark.llm import spelling
from tidemark.llm.spelling import RUNS, LOWERED, code_points, near_words, single_edits, spelling_variants



def is_near(a, b):
    """One inserted, deleted or replaced code point, by trying all of them."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(docs, noise):
    counts = Counter()
    for key, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWERED)
            drawn = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if noise and drawn % noise == 0:
                run = run[: drawn % len(run)] + run[drawn % len(run) + 1 :]
            counts[run] += 1
    return counts


def plain(docs, noise=97, least=3):
    words = {w: n for w, n in plain_counts(docs, noise).items() if len(w) >= 5 and n >= least}
    forms, out = {}, []
    for word, n in words.items():
        near = [v for v in words if is_near(word, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[word] = best if best and words[best] >= 2 * n else None
        out.append([word, forms[word], None, n, len(near), words.get(forms[word])])
    for row in out:
        row[2] = row[0]
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(tuple, out))


def result(found):
    names = ("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r[n] for n in names) for r in found.collect())


def some_docs(seed=1, count=60):
    pick = random.Random(seed)
    roots = ["".join(pick.choice("abeé") for _ in range(pick.randint(4, 8))) for _ in range(25)]
    docs = []
    for key in range(count):
        words = []
        for _ in range(pick.randint(0, 80)):
            word = roots[min(int(pick.expovariate(0.2)), 24)]
            if pick.random() < 0.4:
                at = pick.randrange(len(word))
                word = word[:at] + pick.choice(["", "a", "É", "aa"]) + word[at + pick.randint(0, 1) :]
            words.append(word.upper() if pick.random() < 0.1 else word)
        docs.append((key, pick.choice([" ", ", ", "1"]).join(words)))
    # A form that has a form itself.
    return [*docs, (900, "kitten " * 3 + "kittens " * 8 + "kittenss " * 18 + "kittenssé " * 40)]


def test_single_edits_equal_trying_all():
    pick = random.Random(3)
    words = ["".join(pick.choice("abé\U0001d51e") for _ in range(pick.randint(1, 7))) for _ in range(250)]
    words += ["aa", "aaa", "aaaa", "aabaa", "aabbaa"]
    lengths, front, back = code_points(words)
    i, j = map(np.ravel, np.indices((len(words), len(words))))
    near, prefix = single_edits(lengths, front, back, i, j)
    assert near.tolist() == [is_near(words[a], words[b]) for a, b in zip(i, j)]
    assert near.sum() > 100 and prefix.max() == 7


@pytest.mark.parametrize("block,size,pairs", [(512, 200_000, 1 << 22), (4, 60, 40), (1, 1, 1)])
def test_equals_brute_force_whatever_the_tiles(spark, monkeypatch, block, size, pairs):
    for name, value in (("BLOCK", block), ("BIN", size), ("PAIRS", pairs)):
        monkeypatch.setattr(spelling, name, value)
    docs = some_docs(count=60 if block > 1 else 25)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    expected = plain(docs)
    assert sum(row[1] is not None for row in expected) > 5 and any(row[1] != row[2] for row in expected if row[1])
    assert result(spelling_variants(frame, noise=97)) == expected


def test_a_hot_half_is_cut_and_loses_no_link(spark, monkeypatch):
    """Most words share their first half, so that their group takes many tiles."""
    monkeypatch.setattr(spelling, "BLOCK", 16)
    pick = random.Random(5)
    words = list({"prefix" + "".join(pick.choice("abc") for _ in range(pick.randint(3, 6))) for _ in range(300)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    found = [(r["word"], r["near"]) for r in near_words(frame).collect()]
    assert sorted(found) == sorted((a, b) for a in words for b in words if is_near(a, b))


def test_counts_flow_over_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 5)
    docs = some_docs(2)
    counted = spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string"), 97)
    assert {r["word"]: r["n"] for r in counted.collect()} == dict(plain_counts(docs, 97))


def test_very_long_words(spark):
    long = "q" * 50_000
    docs = [(i, f"{long} {long}x {long[:100]} {long[:101]}") for i in range(3)]
    got = result(spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert [(len(r[0]), r[4]) for r in got] == [(100, 1), (101, 1), (50_000, 1), (50_001, 1)]


def test_awkward_rows(spark):
    expected = plain(awkward_texts(), 97)
    assert result(spelling_variants(awkward_docs(spark), noise=97)) == expected
    assert spelling_variants(no_docs(spark)).count() == 0
    nothing = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert spelling_variants(nothing).count() == 0


def test_circles_are_refused(spark):
    with pytest.raises(ValueError, match="ratio"):
        spelling_variants(no_docs(spark), ratio=1)
