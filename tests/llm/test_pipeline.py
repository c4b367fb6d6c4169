import os
import subprocess
import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm import test_decontaminate, test_near_dup
from tests.llm.cases import awkward_docs, awkward_texts
from tidemark.session import cut_lineage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, cut_lineage(stage(spark, docs, SF_DIR))))
        docs = out[-1][2]
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_all_but_the_last_keep_the_columns(steps):
    assert [n for n in steps] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    for name, (before, after) in steps.items():
        assert (after.columns == before.columns) == (name != "packing")


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    before, after = map(texts, steps["toxicity"])
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    known = [k for k in before if k in toxic]
    # Some sixty labelled rows to learn from, and junk documents whose label no word shows.
    assert sum((k in after) == bool(toxic[k]) for k in known) <= 0.1 * len(known)
    assert all(after[k] == before[k] for k in after)


def test_one_of_each_group_stays(steps):
    before, after = map(texts, steps["near_duplicates"])
    kept = {key for (key, _, _, k) in test_near_dup.plain(list(before.items()), 80) if k}
    assert set(after) == kept


def test_benchmark_documents_go(spark, steps):
    before, after = map(texts, steps["decontamination"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    dirty = {k for k, t in before.items() if test_decontaminate.plain(items, t)[1]}
    assert dirty and set(after) == set(before) - dirty


def test_secrets_are_replaced(steps):
    before, after = map(texts, steps["secrets"])
    assert set(before) == set(after)
    changed = [k for k in before if before[k] != after[k]]
    assert all("<secret>" in after[k] for k in changed)
    assert steps["secrets"][1].filter(F.length("text") != F.col("n_chars")).count() == 0


def test_everything_left_is_packed(steps):
    before, after = steps["packing"]
    pieces = {}
    for r in after.select("doc_id", "start", "length", "doc_tokens", "offset").collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"], r["offset"]))
    assert set(pieces) == {r["doc_id"] for r in before.select("doc_id").collect()}
    for parts in pieces.values():
        ends = 0
        for start, length, _, offset in sorted(parts):
            assert (start, offset) == (ends, 0) and length & (length - 1) == 0 and length <= 4096
            ends += length
        assert {tokens for _, _, tokens, _ in parts} == {ends}


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF_DIR).count() == steps["packing"][1].count()


def clashing(spark):
    """Awkward rows with text columns named like what stages make."""
    docs = awkward_docs(spark)
    return docs.withColumns({name: F.lit(name) for name in ("score", "held_out", "predicted", "covered", "items", "component_id")})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_awkward_clashing_and_empty_tables(spark, name, stage):
    docs = clashing(spark)
    after = cut_lineage(stage(spark, docs, SF_DIR))
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    if name == "packing":
        # Repeated rows and keys are packed once each; a text without words is one piece.
        assert after.filter("start = 0").count() == docs.count()
        return
    assert after.dtypes == docs.dtypes
    same = [c for c in docs.columns if c not in ("text", "n_chars")] if name == "secrets" else docs.columns
    assert after.select(same).exceptAll(docs.select(same)).count() == 0
    kept = {(r["doc_id"], r["text"]) for r in after.collect()}
    if name == "secrets":
        assert after.count() == docs.count()
    # Texts without words are never toxic, linked, contaminated or secret.
    assert {(1, None), (2, ""), (None, None)} <= kept
    if name == "near_duplicates":
        assert (10, awkward_texts()[9][1]) not in kept and after.filter("doc_id = 15").count() == 2


def test_the_optional_part_needs_its_modules_only(tmp_path):
    """Without a third-party module of the optional part the entry keeps the core queries; other faults are not hidden."""
    code = (
        "import sys; sys.modules['{}'] = None\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()))"
    )
    root = os.path.dirname(corpus_pipeline.__file__)

    def run(module):
        return subprocess.run([sys.executable, "-W", "ignore", "-c", code.format(module)], cwd=root, capture_output=True, text=True)

    count, there = run("public_tokenizers").stdout.split()
    assert int(count) > 150 and there == "False"
    assert run("numpy").returncode != 0
