import itertools
import random
import zlib

import pytest

from tests.llm.cases import DOCS, EXTRA, awkward_docs, awkward_texts, no_docs
from tidemark.llm import toxicity
from tidemark.llm.toxicity import Model, Reader, Restorer, Scorer, fit_weights, language_model, score_documents, simplified, spans

BAD = ("grumbler", "sneakthief", "blockhead")


def corpus(spark):
    pick = random.Random(4)
    syllables = ["ta", "ren", "lo", "mi", "sand", "or", "ke", "vul"]
    texts, labels = [], []
    for key in range(600):
        words = ["".join(pick.choice(syllables) for _ in range(pick.randint(1, 3))) for _ in range(pick.randint(5, 60))]
        toxic = key % 5 == 0
        for _ in range(2 * toxic):
            words.insert(pick.randrange(len(words)), pick.choice(BAD))
        texts.append((key, " ".join(words), "en", "s", None, *EXTRA))
        labels.append((key, int(toxic)))
    hidden = ["gr umbler", "blockhead", "8l0ckh3ad", "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "blooockkkkhead", "$neakthief", "GRUMBLER!!!"]
    texts += [(1000 + i, f"ta renlo mi {h} sandor ke", "en", "s", None, *EXTRA) for i, h in enumerate(hidden)]
    return spark.createDataFrame(texts, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus(spark)
    return {r["doc_id"]: r for r in score_documents(docs, labels).collect()}


def test_held_out_rows(scored):
    out = [r for k, r in scored.items() if k < 600 and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in scored.items())
    assert len(out) > 150
    wrong = sum(r["predicted"] != int(r["doc_id"] % 5 == 0) for r in out)
    assert wrong <= 2
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored.values())


def test_obfuscated_words_are_found(scored):
    assert [k for k in range(1001, 1008) if not scored[k]["predicted"]] == []


def test_restoring(spark):
    docs, _ = corpus(spark)
    restore = Restorer(language_model(docs))
    for piece, plain in [("bl0ckhead", "blockhead"), ("b-l-o-c-k-h-e-a-d", "blockhead"), ("grumb*er", "grumbler"), ("tarenlo", "tarenlo")]:
        assert restore(piece).strip() == plain
    assert restore("") == "" and simplified("ｇｒｕ​mbler") == "grumbler"


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(1, 0), (4, 1), (6, 1), (6, 0), (7, None), (None, 1), (9, 0), (999, 1)], "doc_id long, toxic int")
    rows = score_documents(docs, labels)
    assert rows.columns[: len(docs.columns)] == [c for c in docs.columns]
    assert rows.count() == len(awkward_texts())
    # Without labels of both classes there is one score for all.
    none = score_documents(docs, labels.limit(0)).select("score", "predicted").distinct().collect()
    assert len(none) == 1 and none[0]["predicted"] == 0
    assert score_documents(no_docs(spark), labels).count() == 0


def test_weights_need_two_classes():
    assert fit_weights([([0], 1)], ["a"])[0] == {}
    weights, intercept = fit_weights([([0], 1), ([], 0)] * 20, ["a"])
    assert weights["a"] + intercept > 1 > 0 > intercept


def test_marks_digits_and_groups_reach_the_lattice(spark):
    words = "stupid worthless ass evil idiot you are the man".split()
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(50)], "doc_id long, text string")
    language = language_model(docs)
    reader = Reader(language)
    found = [
        ("$$tupid", "stupid"), ("worthle$$", "worthless"), ("worthle$$!!", "worthless"), ("a$$", "ass"), ("!!$$tupid", "stupid"),
        ("@$$", "ass"), ("455", "ass"), ("evi|", "evil"), ("**evil**", "evil"),
    ]
    assert [piece for piece, plain in found if plain not in reader.words(piece)] == []
    apart = ["st up id", "i\nd\ni\no\nt", "i\u00a0d\u00a0i\u00a0o\u00a0t", "you st up id man", "you are i d i o t."]
    read = [set().union(*map(reader.span, spans(text))) for text in apart]
    assert [text for text, found in zip(apart, read) if not {"stupid", "idiot"} & found] == []
    scorer = Scorer(Model(language, {f"={w}": 5.0 for w in ("stupid", "worthless", "ass", "evil", "idiot")}, -2.0))
    assert [text for text in [*dict(found[:-1]), *apart, "4 5 5"] if scorer(text) < 0.7] == []
    assert scorer("you are the man") < 0.2


def test_plain_groups_are_skipped_without_loss(spark):
    docs, _ = corpus(spark)
    scorer = Scorer(Model(language_model(docs), {"=taren": 1.0, "4sand": 1.0, "=oor": 1.0, "=mi": 1.0}, 0.0))
    pick = random.Random(7)
    for _ in range(300):
        span = " ".join(pick.choice(["ta", "ren", "or", "o", "mi", "sa", "nd", "an", "d", "oo"]) for _ in range(pick.randint(3, 7)))
        assert set(scorer.read_span(span)) >= set(scorer.telling(scorer.reader.span(span, [])))


def test_repeated_rows_and_contents_stay_within_the_sample(spark, monkeypatch):
    docs, labels = corpus(spark)
    seen = []
    monkeypatch.setattr(toxicity, "fit_weights", lambda rows, names: seen.append(len(rows)) or fit_weights(rows, names))
    keys = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 != 1]
    once = docs.filter(f"doc_id = {keys[0]}")
    many = docs
    for _ in range(5):
        many = many.union(once)
    toxicity.train(many, labels)
    assert seen == [len(keys)]
    contents = spark.createDataFrame([(keys[0], f"text {i}") for i in range(40)], "doc_id long, text string")
    toxicity.train(contents, labels, max_labelled=10_000)
    toxicity.train(contents, spark.createDataFrame([(keys[0], 1)], "doc_id long, toxic int"), max_labelled=7)
    assert seen[1:] == [40, 7]


def random_piece(pick):
    parts = ["grum", "bler", "block", "head", "a", "ss", "4", "$", "5", "0", "8l", "*", "-", ".", "oo", "kk", "е", "1", "|", "x", "(", "#"]
    return "".join(pick.choice(parts) for _ in range(pick.randint(1, 7)))


def test_pieces_that_spell_nothing_told_are_skipped_without_loss(spark):
    """Scoring with the automaton finds exactly the telling words that decoding everything finds."""
    docs, _ = corpus(spark)
    weights = {"=grumbler": 1.0, "5block": 1.0, "4asso": 1.0, "=ass": 1.0, "4oste": 1.0}
    scorer = Scorer(Model(language_model(docs), weights, 0.0))
    pick = random.Random(11)
    skipped = 0
    for _ in range(1500):
        piece = random_piece(pick)
        everything = set(scorer.telling(scorer.reader.words(piece)))
        spelt = scorer.spells(simplified(piece))
        skipped += not spelt
        assert set(scorer.read(piece)) == everything, piece
    assert 300 < skipped < 1400
    for _ in range(200):
        span = " ".join(random_piece(pick)[: pick.randint(1, 3)] for _ in range(pick.randint(3, 8)))
        if not scorer.spells(simplified(span)):
            assert not scorer.telling(scorer.reader.span(span)), span


def test_viterbi_equals_trying_all_paths(spark):
    """The best path of small lattices against every combination of options."""
    docs, _ = corpus(spark)
    restore = Restorer(language_model(docs))

    def cost_of(path):
        a, b, total = 0, 0, 0.0
        for out, cost in path:
            total -= cost
            for char in out:
                z = toxicity.EDGE if char == " " else toxicity.SYMBOL.get(char, toxicity.OTHER)
                if z == b == toxicity.EDGE:
                    continue
                total += restore.language[a][b][z]
                a, b = b, z
        return total + (restore.language[a][b][toxicity.EDGE] if b != toxicity.EDGE else 0.0)

    for piece in ["8l0ck", "a$$", "g.r-u", "1d10t", "b*d", "oo0", "$t", "455"]:
        paths = list(itertools.product(*restore.lattice(piece)))
        best = max(map(cost_of, paths))
        read = restore(piece)
        assert any(abs(cost_of(p) - best) < 1e-6 and "".join(out for out, _ in p) == read for p in paths), piece


def test_rejecting_keeps_columns_named_like_results(spark):
    docs, labels = corpus(spark)
    named = docs.selectExpr("doc_id", "text", "lang AS score", "source AS held_out", "'mine' AS predicted")
    kept = toxicity.reject_documents(named, labels)
    assert kept.dtypes == named.dtypes
    assert kept.filter("score = 'en' AND held_out = 's' AND predicted = 'mine'").count() == kept.count() < docs.count()
    scored = {r["doc_id"] for r in score_documents(docs, labels).filter("predicted = 0").collect()}
    assert {r["doc_id"] for r in kept.collect()} == scored
