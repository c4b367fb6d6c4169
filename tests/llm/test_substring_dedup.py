import random
from collections import Counter

import pytest

from tests.llm.cases import DOCS, EXTRA, awkward_docs, awkward_texts, no_docs, prose
from tidemark.llm.substring_dedup import remove_repeats


def plain(cases, size=13):
    split = [(key, (text or "").encode().split()) for key, text in cases]
    late = float("inf")
    least = {}
    for key, words in split:
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            least[window] = min(late if key is None else key, least.get(window, late))
    out = Counter()
    for key, words in split:
        gone = set()
        for i in range(len(words) - size + 1):
            if least[tuple(words[i : i + size])] < (late if key is None else key):
                gone |= set(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out[(key, len(words), len(gone), kept)] += 1
    return out


def result(rows):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows)


def frame(spark, cases):
    return spark.createDataFrame([(k, t, "en", "s", None, *EXTRA) for k, t in cases], DOCS).repartition(3)


def test_awkward_rows(spark):
    rows = remove_repeats(awkward_docs(spark)).collect()
    assert result(rows) == plain(awkward_texts())
    assert sum(r["n_removed"] for r in rows) > 30_000


def test_repeats_at_every_offset(spark):
    pick = random.Random(3)
    passages = [prose(n, 70 + n) for n in (12, 13, 14, 19, 20, 26, 60)]
    cases = []
    for key in range(120):
        parts = [prose(pick.randrange(0, 25), 1000 + key)]
        for _ in range(pick.randrange(4)):
            parts += [pick.choice(passages), prose(pick.randrange(0, 4), pick.randrange(10**6))]
        cases.append((key, " ".join(parts)))
    # Few different words: windows repeat within and across documents.
    cases += [(200 + k, " ".join(pick.choice("ab") for _ in range(80))) for k in range(6)]
    assert result(remove_repeats(frame(spark, cases)).collect()) == plain(cases)
    assert result(remove_repeats(frame(spark, cases), size=5, block=3).collect()) == plain(cases, 5)


def test_parameters_and_empty_table(spark):
    with pytest.raises(ValueError):
        remove_repeats(no_docs(spark), size=13, block=8)
    assert remove_repeats(no_docs(spark)).count() == 0
