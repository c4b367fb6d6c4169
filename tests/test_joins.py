"""Joins, salting, plans, predicates."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.fixtures import day, orders, plan_of, rows, staff
from tidemark import schemas
from tidemark.functions.scalars import safe_cast
from tidemark.operators import joins, layout, predicates, sets, skew


@pytest.fixture(scope="module")
def people(spark):
    return staff(spark)


@pytest.fixture(scope="module")
def sales(spark):
    return orders(spark)


@pytest.mark.parametrize(
    "how,count", [("inner", 14), ("left", 25), ("right", 15), ("full", 26), ("left_semi", 4), ("left_anti", 11)]
)
def test_join_counts(people, sales, how, count):
    assert people.join(sales, "emp_id", how).count() == count


def test_left_join_with_filter_equals_anti_join(people, sales):
    never = people.join(sales, "emp_id", "left").filter("order_id IS NULL").select("emp_id")
    assert rows(never) == rows(people.join(sales, "emp_id", "left_anti"), "emp_id")


def test_orphans(spark, people, sales):
    assert rows(joins.orphans(sales, people, ["emp_id"]), "order_id") == [(1013,)]
    null_key = sales.limit(1).withColumn("emp_id", F.lit(None).cast("int"))
    assert joins.orphans(null_key, people, ["emp_id"]).count() == 1


def test_ambiguous_key_needs_an_alias(people, sales):
    joined = people.alias("p").join(sales.alias("o"), F.col("p.emp_id") == F.col("o.emp_id"))
    with pytest.raises(AnalysisException, match="AMBIGUOUS_REFERENCE"):
        joined.select("emp_id")
    assert joined.select("p.emp_id").count() == 14


def test_implicit_cartesian_product_is_refused(spark, people, sales):
    assert spark.conf.get("spark.sql.crossJoin.enabled") == "false"
    with pytest.raises(AnalysisException, match="cartesian"):
        people.join(sales).count()


def test_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v2 string")
    assert rows(left.join(right, "k")) == [(1, "a", "x")]
    assert rows(joins.null_safe_join(left, right, ["k"])) == [(1, "a", "x"), (None, "b", "y")]
    assert joins.null_safe_join(left, right, ["k"], "left_anti").count() == 0
    more = right.union(spark.createDataFrame([(7, "z")], right.schema))
    assert rows(joins.null_safe_join(left, more, ["k"], "full")) == [(1, "a", "x"), (7, None, "z"), (None, "b", "y")]


def test_broadcast_and_merge_plans(people, sales):
    assert "BroadcastHashJoin" in plan_of(sales.join(F.broadcast(people), "emp_id"))
    merged = plan_of(sales.join(people.hint("merge"), "emp_id"))
    assert "SortMergeJoin" in merged and "BroadcastHashJoin" not in merged.split("Initial Plan")[0]


def versions(spark):
    return spark.createDataFrame(
        [
            (71, "Orla", "basic", day("2021-03-10"), day("2021-09-05"), False),
            (71, "Orla", "plus", day("2021-09-05"), None, True),
            (88, "Piet", "basic", day("2020-12-24"), None, True),
        ],
        schemas.customer_dimension(),
    )


def facts(spark):
    return spark.createDataFrame(
        [(501, 71, 12.5, day("2021-09-04")), (502, 71, 7.0, day("2021-09-05")), (503, 71, 3.25, day("2021-03-09")),
         (504, 60, 8.0, day("2021-05-01"))],
        schemas.customer_orders(),
    )


def test_point_in_time_join(spark):
    got = joins.pit_join(facts(spark), versions(spark), ["cust_id"], "order_date")
    assert rows(got, "order_id", "tier") == [(501, "basic"), (502, "plus"), (503, None), (504, None)]
    inner = joins.pit_join(facts(spark), versions(spark), ["cust_id"], "order_date", how="inner")
    assert rows(inner, "order_id", "tier") == [(501, "basic"), (502, "plus")]
    assert "NestedLoop" not in plan_of(got)
    with pytest.raises(ValueError):
        joins.pit_join(facts(spark), versions(spark), ["cust_id"], "order_date", how="full")


def test_point_in_time_join_shows_overlaps(spark):
    clash = versions(spark).withColumn("effective_end", F.lit(None).cast("date"))
    got = joins.pit_join(facts(spark), clash, ["cust_id"], "order_date")
    assert rows(got.filter("order_id = 502"), "tier") == [("basic",), ("plus",)]


def test_range_join_equals_comparison_of_all_pairs(spark):
    points = spark.range(200).select((F.col("id") * 7 % 101 / 3 - 5).alias("x"), "id")
    ranges = spark.range(12).select((F.col("id") * 3.5 - 6).alias("lo"), (F.col("id") * 4.1).alias("hi"),
                                    F.col("id").alias("r"))
    got = joins.range_join(points, ranges, F.col("x"), "lo", "hi", 2.5)
    want = [(p["id"], r["r"]) for p in points.collect() for r in ranges.collect() if r["lo"] <= p["x"] < r["hi"]]
    assert rows(got, "id", "r") == sorted(want, key=lambda t: tuple((False, str(v)) for v in t))
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    left = joins.range_join(points, ranges, F.col("x"), "lo", "hi", 2.5, "left")
    assert left.select("id").distinct().count() == 200
    alone = 200 - got.select("id").distinct().count()
    assert left.count() == len(want) + alone and left.filter("r IS NULL").count() == alone


def test_range_join_does_not_list_wide_ranges_cell_by_cell(spark):
    points = spark.range(100).select((F.col("id") * 10_000.0).alias("x"), "id")
    ranges = spark.createDataFrame([(0.0, 1e6, "wide"), (10.0, 10.5, "narrow"), (5.0, 5.0, "empty")], "lo double, hi double, r string")
    got = joins.range_join(points, ranges, F.col("x"), "lo", "hi", 1.0)
    assert rows(got, "r").count(("wide",)) == 100 and got.count() == 100
    none = joins.range_join(points, ranges.limit(0), F.col("x"), "lo", "hi", 1.0, "left")
    assert none.count() == 100


# --- skew -------------------------------------------------------------------

N = 24_000
#: Of every twelve rows ten belong to the busiest shop.
BUSY = "shop-0"
BUSY_SHARE = 10 / 12


@pytest.fixture(scope="module")
def hot(spark):
    """Sales of one busy shop among 400 quiet ones; shops are numbered by the square of the row number."""
    quiet = F.format_string("shop-%d", F.pmod(F.col("id") * F.col("id"), F.lit(400)) + 1)
    shop = F.when(F.pmod("id", F.lit(12)) < 10, F.lit(BUSY)).otherwise(quiet)
    return spark.range(N).select("id", shop.alias("key"), (F.col("id") % 7).alias("value")).persist()


def test_salting_balances_partitions(hot):
    plain = skew.partition_balance(layout.co_locate(hot, ["key"], 8)).first()
    salted = skew.add_salt(hot, ["id"], 8)
    spread = skew.partition_balance(layout.co_locate(salted, ["key", skew.SALT], 16)).first()
    assert plain["largest"] >= N * BUSY_SHARE
    assert spread["largest"] < plain["largest"] / 2.5
    assert skew.partition_profile(hot).agg(F.sum("row_count")).first()[0] == N


def test_salted_aggregate_equals_plain(hot):
    want = hot.groupBy("key").agg(
        F.sum("value").alias("s"), F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.avg("value").alias("m"),
    )
    got = skew.salted_agg(
        hot, ["key"], ["id"], 8, {"s": "value"}, {"n": "value"}, {"lo": "value"}, {"hi": "value"}, {"m": "value"}
    )
    assert rows(got) == rows(want)


def test_salted_aggregate_null_rules(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5), (3, None, None)], "id int, key string, v int")
    got = skew.salted_agg(df, ["key"], ["id"], 4, {"s": "v"}, {"n": "v"}, avgs={"m": "v"})
    assert rows(got) == [("a", None, 0, None), (None, 5, 1, 5.0)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("per_salt", [40, 10**6])
def test_salted_join_equals_plain(spark, hot, how, per_salt):
    small = spark.createDataFrame([(BUSY, 1), (BUSY, 2), ("shop-5", 3), ("none", 4), (None, 5)], "key string, tag int")
    got = skew.salted_join(hot, small, ["key"], ["id"], per_salt, how)
    assert rows(got.groupBy(*got.columns[1:]).count()) == rows(
        (want := hot.join(small, "key", how)).groupBy(*want.columns[1:]).count()
    )


def test_only_large_keys_get_salts_and_as_many_as_they_need(spark, hot):
    small = spark.createDataFrame([(BUSY, 1), ("shop-5", 2), (None, 3)], "key string, tag int")
    busy = hot.filter(F.col("key") == BUSY).count()
    step = busy // 5
    salts = -(-busy // step)
    assert rows(skew.salt_counts(hot, ["key"], step)) == [(BUSY, salts)]
    left, right = skew.salted_parts(hot, small, ["key"], ["id"], step)
    sizes = [r["count"] for r in left.groupBy("key", skew.SALT).count().collect()]
    assert sum(sizes) == N and max(sizes) <= 1.3 * step
    assert rows(right.groupBy("tag").count()) == [(1, salts), (2, 1), (3, 1)]


def test_salted_join_refuses_right_and_full(hot):
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            skew.salted_join(hot, hot, ["key"], ["id"], how=how)


def test_key_skew_and_hot_keys(hot):
    top = skew.key_skew(hot, ["key"], 3).first()
    assert (top["key"], top["share"]) == (BUSY, pytest.approx(BUSY_SHARE))
    assert rows(skew.hot_keys(hot, ["key"], 0.05)) == [(BUSY,)]
    with pytest.raises(ValueError):
        skew.hot_keys(hot, ["key"], 0)


def test_salt_is_stable(hot):
    one, two = (skew.add_salt(hot, ["id"], 8).agg(F.sum(F.xxhash64("id", skew.SALT) % 1000)).first() for _ in range(2))
    assert one == two


def test_round_robin_and_key_partitions(hot):
    even = skew.partition_balance(layout.spread(hot, 5)).first()
    assert even["partitions"] == 5 and even["ratio"] < 1.1
    placed = layout.co_locate(hot, ["key"], 5).select("key", F.spark_partition_id().alias("p"))
    assert placed.groupBy("key").agg(F.count_distinct("p").alias("n")).filter("n > 1").count() == 0


def test_one_shuffle_serves_several_steps(hot, spark):
    placed = layout.co_locate(hot, ["key"], 4)
    plan = plan_of(placed.groupBy("key").agg(F.sum("value").alias("s")).filter("s > 0"))
    assert plan.split("Initial Plan")[0].count("Exchange ") == 1


def test_reused_branch_is_released(spark, sales):
    with layout.reused(sales) as kept:
        assert kept.count() == 15
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not sales.storageLevel.useMemory


# --- predicates, sets -------------------------------------------------------


def test_not_in_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    some = spark.createDataFrame([(1,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    for other in (empty, some, with_null):
        left.createOrReplaceTempView("l")
        other.createOrReplaceTempView("r")
        want = rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)"))
        assert rows(predicates.not_in(left, "k", other, "k")) == want
    assert predicates.not_in(left, "k", with_null, "k").count() == 0


def test_cast_failures(spark):
    df = spark.createDataFrame([("12",), ("bad",), (None,)], "t string")
    assert rows(df.select(safe_cast("t", "int").alias("v"))) == [(12,), (None,), (None,)]
    assert rows(predicates.cast_failures(df, "t", "int")) == [("bad",)]


def test_parameters_are_inert(spark, people):
    got = predicates.run_sql(
        spark, "SELECT * FROM {p} WHERE name = :name", {"name": "x' OR '1'='1"}, p=people
    )
    assert got.count() == 0


def test_dynamic_filters(sales):
    assert predicates.filter_all(sales, []).count() == 15
    assert predicates.filter_all(sales, [F.col("region") == "West", F.col("amount") > 300]).count() == 4
    assert predicates.allowed_name("region", sales.columns) == "region"
    with pytest.raises(ValueError):
        predicates.allowed_name("region; DROP TABLE x", sales.columns)


def test_sql_and_frame_give_one_plan(spark):
    from tidemark.queries import projection
    from tidemark.queries._registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    assert projection.sql_df_twin(t).sameSemantics(projection.sql_df_twin_frame(t))


def test_union_refuses_other_column_order(spark, people):
    a = people.select("emp_id", "name")
    with pytest.raises(ValueError):
        sets.union_all(a, people.select("name", "emp_id"))
    assert sets.union_all(a, a, a).count() == 45
    assert sets.union_by_name(a, people.select("name", "emp_id")).columns == ["emp_id", "name"]
    assert sets.union_by_name(a, people.select("emp_id"), fill_missing=True).filter("name IS NULL").count() == 15


def test_salary_bands(people):
    band = (
        F.when(F.col("salary").isNull(), "unknown").when(F.col("salary") >= 100000, "high")
        .when(F.col("salary") >= 70000, "mid").otherwise("low")
    )
    assert rows(people.groupBy(band.alias("b")).count()) == [("high", 3), ("low", 4), ("mid", 7), ("unknown", 1)]


def test_bare_literal_is_not_a_column(people):
    with pytest.raises(Exception, match="NOT_COLUMN"):
        people.withColumn("x", True)


def test_all_null_aggregates(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v int")
    assert rows(df.groupBy("k").agg(F.sum("v"), F.count("v"), F.avg("v"))) == [(1, None, 0, None)]
    assert df.filter("k > 5").groupBy("k").count().count() == 0


def test_nulls_sort_where_told(people):
    first = people.orderBy(F.col("salary").asc_nulls_first()).first()["emp_id"]
    last = people.orderBy(F.col("salary").asc_nulls_last()).tail(1)[0]["emp_id"]
    assert first == last == 13
