"""Gates, dead letters, reconciliation."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from tidemark.operators import quality as q

SCHEMA = "order_id int, emp_id int, customer string, amount double"


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([(4,), (5,), (6,), (6,)], "emp_id int")


def checks(known):
    return [q.not_null("customer"), q.positive("amount")], [q.Ref("unknown_emp_id", "emp_id", known, "emp_id")]


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_clean_batch_passes(spark, known):
    rules, refs = checks(known)
    counts = q.gate(batch(spark, (1, 4, "alice", 10.0), (2, 5, "bob", 20.0)), rules, refs)
    assert counts == {"row_count": 2, "customer_missing": 0, "amount_not_positive": 0, "unknown_emp_id": 0}


def test_empty_batch_fails(spark, known):
    rules, refs = checks(known)
    with pytest.raises(q.DataQualityError, match="at least 1"):
        q.gate(batch(spark), rules, refs)


@pytest.mark.parametrize(
    "row,reason",
    [
        ((1, 4, None, 10.0), "customer_missing"),
        ((1, 4, "alice", -5.0), "amount_not_positive"),
        ((1, 4, "alice", None), "amount_not_positive"),
        ((1, 999, "alice", 5.0), "unknown_emp_id"),
        ((1, None, "alice", 5.0), "unknown_emp_id"),
    ],
)
def test_each_defect_fails_the_gate(spark, known, row, reason):
    rules, refs = checks(known)
    with pytest.raises(q.DataQualityError, match=reason):
        q.gate(batch(spark, row), rules, refs)


def test_all_failures_are_reported_at_once(spark, known):
    rules, refs = checks(known)
    with pytest.raises(q.DataQualityError) as caught:
        q.gate(batch(spark, (1, 999, None, -1.0)), rules, refs, min_rows=2)
    assert len(caught.value.failures) == 4


def test_bad_copy_leaves_good_copy_alone(spark, known):
    rules, refs = checks(known)
    good, dead = q.split_bad(
        batch(spark, (1, 4, "a", 5.0), (1, 4, "a", -5.0), (2, 5, "b", 1.0), (2, 5, "b", 1.0)), rules, refs
    )
    assert rows(good) == [(1, 4, "a", 5.0), (2, 5, "b", 1.0), (2, 5, "b", 1.0)]
    assert rows(dead) == [(1, 4, "a", -5.0, ["amount_not_positive"])]


def test_reasons_accumulate(spark, known):
    rules, refs = checks(known)
    _, dead = q.split_bad(batch(spark, (1, None, None, None)), rules, refs)
    assert rows(dead, "reasons") == [(["customer_missing", "amount_not_positive", "unknown_emp_id"],)]


def test_split_is_complete(spark, known):
    rules, refs = checks(known)
    df = batch(spark, *[(i, [4, 5, 999, None][i % 4], ["a", None][i % 2], [1.0, -1.0, None][i % 3]) for i in range(60)])
    good, dead = q.split_bad(df, rules, refs)
    assert q.reconcile(df, good, dead).first().asDict() == {
        "bronze_rows": 60, "silver_rows": good.count(), "dead_rows": dead.count(), "balanced": True,
    }
    assert q.reconcile(df, good, dead.limit(0)).first()["balanced"] is False


def test_rate_alert(spark, known):
    rules, refs = checks(known)
    df = batch(spark, (1, 4, "a", 1.0), (2, 4, "a", -1.0), (3, 4, "b", 1.0))
    rate = q.dead_letter_rate(q.tag(df, rules, refs), ["customer"], 0.4)
    assert rows(rate) == [("a", 2, 1, 0.5, True), ("b", 1, 0, 0.0, False)]


def test_custom_rule(spark):
    rule = q.Rule("small", F.col("amount") < 100)
    good, dead = q.split_bad(batch(spark, (1, 1, "a", 1.0), (2, 1, "a", 500.0)), [rule])
    assert good.count() == 1 and rows(dead, "reasons") == [(["small"],)]
