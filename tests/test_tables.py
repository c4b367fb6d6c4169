"""Upserts, versioned tables, type 2 dimensions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from tidemark import schemas
from tidemark.operators import scd
from tidemark.operators import tables as ops

CUST = "cust_id int, name string, tier string, points int"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(11, "Ines", "adult", 31), (12, "Jory", "child", 4), (13, "Kofi", "child", 9)], CUST)


@pytest.fixture(scope="module")
def updates(spark):
    return spark.createDataFrame([(12, "Jory", "child", 17), (14, "Lena", "staff", 2)], CUST)


def test_upsert(target, updates):
    got = ops.upsert(target, updates, ["cust_id"])
    assert rows(got, "cust_id", "points") == [(11, 31), (12, 17), (13, 9), (14, 2)]
    assert rows(ops.upsert(got, updates, ["cust_id"])) == rows(got)


def test_upsert_condition_and_columns(spark, target):
    updates = spark.createDataFrame([(11, "x", "none", 5), (12, "y", "none", 6)], CUST)
    got = ops.upsert(target, updates, ["cust_id"], ["points"], F.col("s_points") > F.col("points"))
    assert rows(got) == [(11, "Ines", "adult", 31), (12, "Jory", "child", 6), (13, "Kofi", "child", 9)]


def test_upsert_can_set_null(spark, target):
    updates = spark.createDataFrame([(11, None, None, None)], CUST)
    assert (11, None, None, None) in rows(ops.upsert(target, updates, ["cust_id"]))


def test_duplicate_update_keys_are_refused(target, updates):
    with pytest.raises(ops.DuplicateKeyError, match="2 times"):
        ops.upsert(target, updates.union(updates), ["cust_id"])


def test_null_keys_never_match(spark, target):
    null_key = spark.createDataFrame([(None, "n", "t", 1)], CUST)
    got = ops.upsert(target.union(null_key), null_key, ["cust_id"])
    assert got.filter("cust_id IS NULL").count() == 2


def test_repeated_target_keys_are_all_updated(target, updates):
    got = ops.upsert(target.union(target), updates, ["cust_id"])
    assert rows(got.filter("cust_id = 12"), "points") == [(17,), (17,)]
    assert got.count() == 7


def test_delete_matched(target, updates):
    assert rows(ops.delete_matched(target, updates, ["cust_id"]), "cust_id") == [(11,), (13,)]


def test_merge_metrics(target, updates):
    got = ops.merge_metrics(target, updates, ["cust_id"]).first().asDict()
    assert got == {"rows_updated": 1, "rows_inserted": 1, "rows_deleted": 0, "rows_unchanged": 2}
    gone = ops.merge_metrics(target, updates, ["cust_id"], delete=F.col("points") < 5).first()
    assert (gone["rows_updated"], gone["rows_deleted"]) == (0, 1)


def test_insert_new_twice(target, updates):
    once = ops.insert_new(target, updates, ["cust_id"])
    assert rows(once, "cust_id", "points") == [(11, 31), (12, 4), (13, 9), (14, 2)]
    assert rows(ops.insert_new(once, updates, ["cust_id"])) == rows(once)


def test_evolve_append(spark, target):
    wider = spark.createDataFrame([(11, "Ines", "adult", 31, "north")], CUST + ", branch string")
    with pytest.raises(ops.SchemaMismatchError):
        ops.evolve_append(target, wider)
    got = ops.evolve_append(target, wider, allow_new=True)
    assert rows(got.filter("cust_id = 11"), "cust_id", "branch") == [(11, "north"), (11, None)]
    clash = target.withColumn("points", F.col("points").cast("string"))
    with pytest.raises(ops.SchemaMismatchError, match="points"):
        ops.evolve_append(target, clash, allow_new=True)


@pytest.fixture(scope="module")
def history(spark):
    at = [dt.datetime(2024, 1, i + 1) for i in range(4)]
    return spark.createDataFrame(
        [
            (1, "a", 0, "upsert", at[0]), (2, "b", 0, "upsert", at[0]),
            (2, "B", 1, "upsert", at[1]),
            (1, None, 2, "delete", at[2]),
            (3, "c", 3, "upsert", at[3]), (1, "again", 3, "upsert", at[3]),
        ],
        "id int, v string, version int, op string, committed_at timestamp",
    )


def test_as_of(history):
    states = [rows(ops.as_of(history, ["id"], n)) for n in range(4)]
    assert states == [
        [(1, "a"), (2, "b")], [(1, "a"), (2, "B")], [(2, "B")], [(1, "again"), (2, "B"), (3, "c")],
    ]
    assert rows(ops.as_of(history, ["id"], timestamp=dt.datetime(2024, 1, 2, 5))) == states[1]
    with pytest.raises(ValueError):
        ops.as_of(history, ["id"])


def test_history_log(history):
    assert rows(ops.history_log(history), "version", "upserts", "deletes") == [(0, 2, 0), (1, 1, 0), (2, 0, 1), (3, 2, 0)]


def test_restore_adds_a_version(history):
    got = ops.restore(history, ["id"], 0, dt.datetime(2024, 2, 1))
    assert rows(ops.current(got, ["id"])) == rows(ops.as_of(history, ["id"], 0))
    assert rows(ops.as_of(got, ["id"], 3)) == rows(ops.as_of(history, ["id"], 3))
    assert rows(got.filter("version = 4"), "id", "op") == [(1, "upsert"), (2, "upsert"), (3, "delete")]


def test_expire(history):
    with pytest.raises(ValueError, match="younger"):
        ops.expire_history(history, ["id"], 2, now=dt.datetime(2024, 1, 5))
    with pytest.raises(ValueError, match="present"):
        ops.expire_history(history, ["id"], 2)
    for kwargs in ({"now": dt.datetime(2024, 1, 20)}, {"force": True}):
        kept = ops.expire_history(history, ["id"], 2, **kwargs)
        for n in (2, 3):
            assert rows(ops.as_of(kept, ["id"], n)) == rows(ops.as_of(history, ["id"], n))
        for earlier in ({"version": 1}, {"timestamp": dt.datetime(2024, 1, 2, 5)}):
            with pytest.raises(Exception, match="folded away"):
                ops.as_of(kept, ["id"], **earlier).collect()
        with pytest.raises(Exception, match="folded away"):
            ops.restore(kept, ["id"], 1, dt.datetime(2024, 2, 1)).collect()
    assert ops.as_of(kept, ["id"], timestamp=dt.datetime(2024, 1, 3)).count() == 1
    assert kept.filter("op <> 'expired'").count() == 3
    assert rows(ops.history_log(kept), "version", "upserts") == [(3, 2)]
    again = ops.expire_history(kept, ["id"], 3, force=True)
    assert rows(ops.current(again, ["id"])) == rows(ops.current(history, ["id"]))
    assert again.filter("op = 'expired'").count() == 1


def test_restore_after_expiry_keeps_rows(spark):
    day = dt.datetime(2024, 1, 1)
    history = spark.createDataFrame(
        [(1, "x", 0, "upsert", day), (2, "y", 0, "upsert", day), (1, "z", 2, "upsert", day), (5, "n", 3, "upsert", day)],
        "id int, v string, version int, op string, committed_at timestamp",
    )
    kept = ops.expire_history(history, ["id"], 2, force=True)
    back = ops.restore(kept, ["id"], 2, day)
    assert rows(ops.current(back, ["id"])) == [(1, "z"), (2, "y")]
    # Nothing is left below the cut, and still reading it fails.
    gone = ops.expire_history(history.filter("version = 3"), ["id"], 2, force=True)
    with pytest.raises(Exception, match="folded away"):
        ops.as_of(gone, ["id"], 1).collect()


def test_rows_without_a_key_are_refused_where_a_rerun_would_repeat_them(spark, target, dim):
    null_key = spark.createDataFrame([(None, "n", "t", 1)], CUST)
    with pytest.raises(ops.NullKeyError):
        ops.insert_new(target, null_key, ["cust_id"])
    with pytest.raises(ops.NullKeyError):
        scd.scd2_apply(dim, incoming(spark, (None, "n", "t")), ["cust_id"], ["tier"], DAY(2024, 2, 1))


def test_unknown_current_flag_loses_no_version(spark, dim):
    vague = dim.withColumn("is_current", F.lit(None).cast("boolean"))
    got = scd.scd2_apply(vague, incoming(spark, (2, "Owen", "large")), ["cust_id"], ["tier"], DAY(2024, 2, 1))
    assert rows(got, "cust_id", "tier") == [(1, "large"), (2, "large"), (2, "small")]
    assert scd.scd2_changes(vague, incoming(spark, (2, "Owen", "large")), ["cust_id"], ["tier"]).count() == 1


# --- dimensions -------------------------------------------------------------

DAY = dt.date


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [(1, "Nuria", "large", DAY(2024, 1, 1), None, True), (2, "Owen", "small", DAY(2024, 1, 1), None, True)],
        schemas.customer_dimension(),
    )


def incoming(spark, *data):
    return spark.createDataFrame(list(data), "cust_id int, name string, tier string")


def test_changes(spark, dim):
    got = scd.scd2_changes(dim, incoming(spark, (1, "Nuria", "large"), (2, "Owen", "large")), ["cust_id"], ["tier"])
    assert rows(got) == [(2, "Owen", "large")]
    to_null = scd.scd2_changes(dim, incoming(spark, (1, "Nuria", None)), ["cust_id"], ["tier"])
    assert rows(to_null) == [(1, "Nuria", None)]


def test_apply(spark, dim):
    news = incoming(spark, (2, "Owen", "large"), (3, "Petra", "tiny"))
    got = scd.scd2_apply(dim, news, ["cust_id"], ["tier"], DAY(2024, 1, 2))
    assert rows(got) == rows(
        spark.createDataFrame(
            [
                (1, "Nuria", "large", DAY(2024, 1, 1), None, True),
                (2, "Owen", "small", DAY(2024, 1, 1), DAY(2024, 1, 2), False),
                (2, "Owen", "large", DAY(2024, 1, 2), None, True),
                (3, "Petra", "tiny", DAY(2024, 1, 2), None, True),
            ],
            schemas.customer_dimension(),
        )
    )
    assert got.columns == dim.columns
    again = scd.scd2_apply(got, news, ["cust_id"], ["tier"], DAY(2024, 1, 2))
    assert rows(again) == rows(got)
    assert rows(scd.scd2_on(got, DAY(2024, 1, 1)), "cust_id", "tier") == [(1, "large"), (2, "small")]
    assert rows(scd.scd2_on(got, DAY(2024, 1, 2)), "cust_id", "tier") == [(1, "large"), (2, "large"), (3, "tiny")]
    assert scd.overlaps(got, ["cust_id"]).count() == 0


def test_apply_null_transitions(spark, dim):
    once = scd.scd2_apply(dim, incoming(spark, (1, "Nuria", None)), ["cust_id"], ["tier"], DAY(2024, 2, 1))
    assert rows(scd.scd2_on(once, DAY(2024, 3, 1)), "cust_id", "tier") == [(1, None), (2, "small")]
    twice = scd.scd2_apply(once, incoming(spark, (1, "Nuria", "large")), ["cust_id"], ["tier"], DAY(2024, 4, 1))
    assert twice.filter("cust_id = 1").count() == 3


def test_apply_refuses_early_dates_and_duplicates(spark, dim):
    late = scd.scd2_apply(dim, incoming(spark, (2, "Owen", "large")), ["cust_id"], ["tier"], DAY(2024, 1, 1))
    with pytest.raises(Exception, match="not later"):
        late.collect()
    with pytest.raises(ops.DuplicateKeyError):
        scd.scd2_apply(dim, incoming(spark, (2, "b", "x"), (2, "b", "y")), ["cust_id"], ["tier"], DAY(2024, 2, 1))


def test_overlaps(spark, dim):
    clash = dim.unionByName(
        spark.createDataFrame([(1, "Nuria", "x", DAY(2024, 5, 1), None, True)], schemas.customer_dimension())
    )
    assert rows(scd.overlaps(clash, ["cust_id"]), "cust_id", "tier") == [(1, "x")]
