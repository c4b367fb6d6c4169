import random
import re
import time
from collections import Counter

from tests.fixtures import plan_of
from tests.llm.cases import awkward_docs, awkward_texts, no_docs, prose
from tidemark.llm.decontaminate import cut_spans, drop_contaminated, find_hits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


ITEMS = [(1, prose(40, 1)), (2, None), (3, ""), (4, "TWICE"), (5, "one two\u00a0three four"), (None, "same key"), (6, prose(40, 1)), (12, prose(12, 99))]


def plain(items, text, n=10):
    grams = {}
    for item, body in items:
        w = words(body)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            grams.setdefault(tuple(w[i : i + k]), set()).add(item)
    w = words(text)
    covered, found = set(), set()
    for k in {len(g) for g in grams}:
        for i in range(len(w) - k + 1):
            held = grams.get(tuple(w[i : i + k]))
            if held:
                covered |= set(range(i, i + k))
                found |= held
    return len(w), tuple(sorted(covered)), tuple(sorted(str(i) for i in found if i is not None))


def benchmark(spark):
    return spark.createDataFrame([(i, t, "w", 1) for i, t in ITEMS], "item_id long, text string, window string, len int")


def test_hits(spark):
    got = Counter(
        (r["doc_id"], r["n_words"], tuple(r["covered"]), tuple(r["items"]))
        for r in find_hits(awkward_docs(spark), benchmark(spark)).collect()
    )
    assert got == Counter((key, *plain(ITEMS, text)) for key, text in awkward_texts())


def test_removal(spark):
    docs = awkward_docs(spark)
    hits = find_hits(docs, benchmark(spark)).cache()
    clean = [(k, t) for k, t in awkward_texts() if not plain(ITEMS, t)[1]]
    kept = drop_contaminated(docs, hits)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(clean)
    cut = {(r["doc_id"], r["text"]) for r in cut_spans(docs, hits).collect()}
    assert set(clean) <= cut and len(cut) == len(set(awkward_texts()))
    left = {k: t for k, t in cut}
    for key, text in awkward_texts():
        if key in (6, 7, 8):
            gone = set(plain(ITEMS, text)[1])
            assert words(left[key]) == [w for i, w in enumerate(words(text)) if i not in gone]


def test_empty_tables(spark):
    assert find_hits(no_docs(spark), benchmark(spark)).count() == 0
    rows = find_hits(awkward_docs(spark), benchmark(spark).limit(0)).collect()
    assert len(rows) == len(awkward_texts()) and not any(r["covered"] for r in rows)


def test_very_long_text_is_linear(spark):
    """Half a million words: the windows do not carry the words of the whole text."""
    pick = random.Random(9)
    words = [f"w{pick.randrange(10**6)}" for _ in range(500_000)]
    words[250_000:250_010] = [f"planted{i}" for i in range(10)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "short")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a", " ".join(f"planted{i}" for i in range(10)))], "item_id string, text string")
    began = time.monotonic()
    found = find_hits(docs, benchmark)
    first = {r["doc_id"]: r for r in found.collect()}
    assert time.monotonic() - began < 60
    assert (first[1]["n_words"], first[1]["covered"], first[2]["covered"]) == (500_000, list(range(250_000, 250_010)), [])
    # What the Generate passes on from the row it expands.
    carried = re.search(r"Generate posexplode.*?\[(key#[^\]]*)\], true", plan_of(found))[1]
    assert [name.split("#")[0] for name in carried.split(", ")] == ["key", "content", "row", "n_words"]
