import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, EXTRA, awkward_docs, awkward_texts, no_docs, prose
from tidemark.llm import near_dup
from tidemark.llm.components import connected
from tidemark.llm.near_dup import agreement, drop_copies, near_duplicates, shingles, sketch


def sets(text, size=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(cases, percent=85):
    """(key, text) -> (shingles, component, kept), rows of one key judged each by its own text."""
    found = [(key, text, sets(text)) for key, text in cases]
    root = list(range(len(found)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (ki, _, a) in enumerate(found):
        for j in range(i):
            kj, _, b = found[j]
            if a and b and ki is not None and kj is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(found):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    out = Counter()
    for i, (key, _, s) in enumerate(found):
        component = None if key is None else least[find(i)]
        out[(key, len(s), component, key is None or key == component)] += 1
    return out


def result(rows):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows)


def test_awkward_rows(spark):
    assert result(near_duplicates(awkward_docs(spark)).collect()) == plain(awkward_texts())


def chain(seed, size, steps, changed):
    """Texts that drift: neighbours are near copies, the ends are not."""
    pick = random.Random(seed)
    words = prose(size, seed).split()
    for _ in range(steps):
        yield " ".join(words)
        for _ in range(changed):
            words[pick.randrange(size)] = f"w{pick.random()}"


@pytest.mark.parametrize("block", [near_dup.BLOCK, 3])
def test_groups_and_chains(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    texts = [t for s in range(3) for t in chain(s, 120, 14, 1)]
    texts += [t for s in range(6) for t in chain(100 + s, 7 + s, 3, 1)]
    base = prose(200, 50).split()
    pick = random.Random(5)
    for _ in range(60):
        copy = list(base)
        for _ in range(pick.randrange(9)):
            copy[pick.randrange(len(copy))] = f"x{pick.random()}"
        texts.append(" ".join(copy))
    texts += texts[:5] * 3
    pick.shuffle(texts)
    cases = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, "en", "s", None, *EXTRA) for k, t in cases], DOCS)
    found = near_duplicates(docs)
    assert result(found.collect()) == plain(cases)
    kept = {r["doc_id"] for r in drop_copies(docs, found).collect()}
    assert kept == {key for (key, _, _, k) in plain(cases) if k}


def test_sketches_estimate(spark):
    a, b = prose(2000, 8).split(), prose(2000, 9).split()
    for share in (0.5, 0.8, 0.95):
        cut = int(2000 * share)
        x, y = shingles(" ".join(a), 5), shingles(" ".join(a[:cut] + b[cut:]), 5)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        estimate, used = agreement(sketch(x)[None], sketch(y)[None], np.array([len(x)]), np.array([len(y)]))
        assert abs(estimate[0] - true) < 0.15 and used[0] == near_dup.REGISTERS


def test_components(spark):
    links = [(5, 1), (2, 1), (3, 3), (9, 8), (8, 7), (7, 9), (None, 4), (20, 19), (19, 18), (18, 17), (17, 16), (16, 15), (1, 5)]
    rows = connected(spark.createDataFrame(links, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in rows} == {
        (5, 1), (2, 1), (9, 7), (8, 7), *[(n, 15) for n in range(16, 21)]
    }
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(spark):
    assert near_duplicates(no_docs(spark)).count() == 0
    assert near_duplicates(awkward_docs(spark).withColumn("text", F.lit(None).cast("string"))).filter("kept").count() == 22
