"""Stored distinct-count sketches against exact counts."""

import re

import pytest
from pyspark.sql import functions as F

from tests.fixtures import plan_of, rows
from tidemark.operators import sketches
from tidemark.queries import QUERIES

BY = ["day", "shop"]


@pytest.fixture(scope="module")
def visits(spark):
    user = F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") * 7919 % 20_011)
    day = F.date_add(F.lit("2024-03-01").cast("date"), (F.col("id") % 10).cast("int"))
    return spark.range(60_000).select(day.alias("day"), (F.col("id") % 3).alias("shop"), user.alias("user"))


def close(spark, path, want, by=None):
    got = {r[:-1]: r[-1] for r in rows(sketches.distinct_from_sketches(spark, path, by))}
    want = {r[:-1]: r[-1] for r in rows(want)}
    assert set(got) == set(want)
    assert all(abs(got[k] - n) <= sketches.error_bound(4) * n + 1 for k, n in want.items())


def test_slices_add_up_to_the_whole(spark, visits, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.store_sketches(visits, path, BY, "user")
    users = F.count_distinct("user").alias("n")
    close(spark, path, visits.agg(users))
    close(spark, path, visits.groupBy("day").agg(users), ["day"])
    close(spark, path, visits.groupBy("shop").agg(users), ["shop"])


def test_a_day_is_added_or_replaced_by_itself(spark, visits, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.store_sketches(visits.filter("day < DATE'2024-03-10'"), path, BY, "user")
    last = visits.filter("day = DATE'2024-03-10'")
    for _ in range(2):
        sketches.replace_sketches(last, path, BY, "user", ["2024-03-10"])
    close(spark, path, visits.agg(F.count_distinct("user").alias("n")))
    assert spark.read.parquet(path).count() == 30
    sketches.replace_sketches(last.limit(0), path, BY, "user", ["2024-03-10"])
    close(spark, path, visits.filter("day < DATE'2024-03-10'").agg(F.count_distinct("user").alias("n")))


def test_sketches_do_not_grow_with_their_rows(spark, visits):
    sizes = sketches.slice_sketches(visits.unionByName(visits), ["shop"], "user").select(F.length(sketches.SKETCH))
    assert max(r[0] for r in sizes.collect()) <= 2**sketches.LOG_SIZE + 64


def test_no_sketch_per_user_beside_the_exact_count(spark, tmp_path):
    user = F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") * 7919 % 2_003)
    kind = F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), F.col("id") % 3))
    events = spark.range(20_000).select(kind.alias("event_type"), user.alias("user_id"))
    nobody = spark.createDataFrame([("none", None)] * 2, events.schema)
    events = events.unionByName(events).unionByName(nobody)
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["approx_distinct_bound"](spark, str(tmp_path))
    plan = plan_of(got)
    want = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n"), F.lit(True))
    assert rows(got) == rows(want) and ("none", 0, True) in rows(got)
    by_user = re.findall(r"Aggregate\(keys=\[[^\]]*user_id[^\]]*\], functions=\[([^\]]*)", plan)
    assert by_user and not any(by_user)
