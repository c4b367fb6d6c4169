"""Python functions and the end-to-end jobs."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.fixtures import day, orders, rows, staff, write_csv, write_lines, write_staff_csv
from tidemark import schemas
from tidemark.functions import udfs
from tidemark.functions.udfs import GroupTooLargeError, apply_grouped, map_grouped, null_safe, udf_null_audit
from tidemark.operators.quality import Rule, positive
from tidemark.operators.windows import zscore
from tidemark.plans import customer_360, daily_load, retail_etl


def test_null_safe_udf(spark):
    raise_ = F.udf(null_safe(lambda s: s * 1.1), "double")
    got = staff(spark).select("emp_id", raise_("salary").alias("r"))
    assert got.filter("r IS NULL").count() == 1
    with pytest.raises(Exception, match="TypeError"):
        staff(spark).select(F.udf(lambda s: s * 1.1, "double")("salary")).collect()


def test_wrong_return_type_loses_rows_silently(spark):
    wrong = F.udf(null_safe(lambda s: f"{s:.0f}"), "int")
    audited = udf_null_audit(staff(spark).withColumn("out", wrong("salary")), ["salary"], "out")
    assert rows(audited) == [(15, 14)]
    right = F.udf(null_safe(lambda s: int(s)), "int")
    assert rows(udf_null_audit(staff(spark).withColumn("out", right("salary")), ["salary"], "out")) == [(15, 0)]


def test_registered_udf(spark):
    spark.udf.register("shout", null_safe(str.upper), "string")
    assert spark.sql("SELECT shout('a') AS a, shout(NULL) AS b").first() == ("A", None)


def center(group: pd.DataFrame) -> pd.DataFrame:
    return group[["emp_id", "department"]].assign(z=(group["salary"] - group["salary"].mean()) / group["salary"].std())


SCHEMA = "emp_id int, department string, z double"


def test_grouped_map_equals_built_in(spark):
    got = apply_grouped(staff(spark), ["department"], center, SCHEMA)
    want = zscore(staff(spark), ["department"], "salary").select("emp_id", "department", "z")
    r = F.round("z", 9)
    assert rows(got.select("emp_id", r)) == rows(want.select("emp_id", r))


def test_group_guard(spark):
    with pytest.raises(GroupTooLargeError, match="Engineering"):
        apply_grouped(staff(spark), ["department"], center, SCHEMA, max_group_rows=5)


def test_map_grouped_over_small_chunks(spark, monkeypatch):
    """Groups in pieces of three rows, states of one task handed on early: the same as plain pandas per group."""
    monkeypatch.setattr(udfs, "HELD_STATES", 1)
    monkeypatch.setattr(udfs, "STATE_PARTS", 2)
    rows_ = [(i, [None, "a", "b"][i % 3] if i < 60 else f"k{i}", None if i % 7 == 0 else float(i % 11)) for i in range(70)]
    df = spark.createDataFrame(rows_, "id int, key string, v double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = map_grouped(
            df, ["key"],
            lambda part: {"n": int(part["v"].count()), "total": float(part["v"].sum())},
            lambda states: {"n": int(states["n"].sum()), "total": float(states["total"].sum())},
            lambda part: part[["id"]].assign(share=part["v"] / part["total"].where(part["n"] > 0)),
            "n long, total double", "id int, share double",
        )
        total = F.sum("v").over(Window.partitionBy("key"))
        assert rows(got.select("id", F.round("share", 9))) == rows(df.select("id", F.round(F.try_divide("v", total), 9)))
        assert map_grouped(df.limit(0), ["key"], dict, dict, lambda p: p[["id"]], "n long", "id int").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pandas_udf_equals_expression(spark):
    @F.pandas_udf("double")
    def grow(s: pd.Series) -> pd.Series:
        return s * 1.1

    got = staff(spark).select("emp_id", grow("salary").alias("s"))
    assert rows(got) == rows(staff(spark).select("emp_id", (F.col("salary") * 1.1).alias("s")))


def test_retail_etl(spark, tmp_path):
    csv, people = write_csv(tmp_path / "orders.csv"), write_staff_csv(tmp_path / "staff.csv")
    for _ in range(2):
        layers = retail_etl.run(spark, csv, people, str(tmp_path / "out"))
        assert (layers.bronze.count(), layers.dead.count(), layers.silver.count()) == (15, 1, 14)
        assert rows(layers.gold["region"]) == [("East", 2500.74, 4), ("North", 1461.24, 3), ("West", 3670.99, 7)]
        assert rows(layers.gold["department"], "department", "total_amount") == [("Sales", 7632.97)]
        best = layers.gold["employee"].orderBy(F.desc("total_amount")).first()
        assert (best["name"], best["total_amount"]) == ("Elena Petrova", 2500.74)


def test_retail_build_equals_run(spark, tmp_path):
    from tidemark.operators.quality import Ref

    people = staff(spark)
    built = retail_etl.build(
        orders(spark), people.select("emp_id", "name", "department"), [positive("amount")],
        [Ref("unknown_emp_id", "emp_id", people, "emp_id")], ["emp_id"], {"region": ["region"]},
    )
    ran = retail_etl.run(
        spark, write_csv(tmp_path / "o.csv"), write_staff_csv(tmp_path / "s.csv"), str(tmp_path / "out")
    )
    assert rows(built.gold["region"]) == rows(ran.gold["region"])


def test_customer_360(spark):
    """Orders keep the tier of their day when a customer moves up, and a fact load may be repeated."""
    opened = day("2023-05-04")
    shops = [(70, "harbour cafe", "basic"), (71, "mill bakery", "plus"), (72, "tower books", "plus")]
    dim = spark.createDataFrame([(*shop, opened, None, True) for shop in shops], schemas.customer_dimension())
    moved = spark.createDataFrame([(72, "tower books", "prime"), (71, "mill bakery", "plus")], "cust_id int, name string, tier string")
    dim = customer_360.next_dimension(dim, moved, ["cust_id"], ["tier"], dt.date(2023, 9, 18))

    def batch(*data):
        return spark.createDataFrame(list(data), schemas.customer_orders())

    facts = customer_360.load_facts(batch(), batch((5001, 72, 9.4, day("2023-06-30"))), ["order_id"])
    later = batch((5002, 72, 31.0, day("2023-09-18")), (5003, 71, 12.5, day("2023-10-02")))
    for _ in range(2):
        facts = customer_360.load_facts(facts, later, ["order_id"])
    assert facts.count() == 3
    got = customer_360.checked_view(facts, dim, ["cust_id"], "order_date", {"tier": "tier_at_order"})
    assert rows(got, "order_id", "tier_at_order") == [(5001, "plus"), (5002, "prime"), (5003, "plus")]
    clash = dim.withColumn("effective_end", F.lit(None).cast("date"))
    with pytest.raises(customer_360.OverlappingVersionsError):
        customer_360.checked_view(facts, clash, ["cust_id"], "order_date", {"tier": "tier_at_order"})


LINES = [
    '{"order_id": 41, "customer": "kiosk north", "amount": 3.75}',
    '{"order_id": 42, "customer": "kiosk south", "amount": 18.2}',
    '{"order_id": 43, "customer": "kiosk west", "amount": ',
    '{"order_id": 44, "customer": "kiosk east", "amount": -0.5}',
]


def test_daily_load_is_retry_safe(spark, tmp_path):
    schema = spark.createDataFrame([], "order_id int, customer string, amount double").schema
    raw, out = write_lines(tmp_path / "day1.json", LINES), str(tmp_path / "out")
    rules = [positive("amount"), Rule("customer_missing", F.col("customer").isNotNull())]
    for _ in range(2):
        silver, dead = daily_load.run(spark, raw, schema, rules, "2024-01-01", out)
        assert (silver.count(), dead.count()) == (2, 2)
    assert rows(dead, "order_id", "reasons", "_corrupt_record") == [
        (44, ["amount_not_positive"], None), (None, ["unparseable"], LINES[2]),
    ]
    # Another day leaves the first one alone; a corrected rerun leaves no stale dead letters.
    daily_load.run(spark, write_lines(tmp_path / "day2.json", LINES[:1]), schema, rules, "2024-01-02", out)
    fixed = write_lines(tmp_path / "day1_fixed.json", LINES[:2])
    silver, dead = daily_load.run(spark, fixed, schema, rules, "2024-01-01", out)
    assert (silver.count(), dead.count()) == (3, 0)


def test_cluster_needs_a_shared_folder(spark):
    from tidemark import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Fake:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Fake())
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_functions_travel_without_the_package(tmp_path):
    """Workers of a cluster need not have this package installed."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tidemark.queries.udfs import _band

    band = _band()
    (tmp_path / "fn.pkl").write_bytes(cloudpickle.dumps((band, null_safe(lambda s: band(s * 200)))))
    code = "import pickle; a, b = pickle.load(open('fn.pkl', 'rb')); print(a(8000.0), b(1), b(None))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.split() == ["high", "low", "None"], done.stderr


def test_gold_filters_reach_the_scan_and_orders_shrink_before_joining(spark):
    import __spark_entry__ as entry
    from tests.fixtures import plan_of

    plan = plan_of(entry.entry(spark)).split("Initial Plan")[0]
    assert "GreaterThan(o_totalprice,5000.0)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    assert "partial_sum(" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_silver_is_pruned_before_the_shuffle(spark):
    import __spark_entry__ as entry
    from tests.fixtures import plan_of

    plan = plan_of(entry.queries()["silver_orders"](spark, "/root/testdata/sf0.001")).split("Initial Plan")[0]
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("kind", ["double", "decimal(10,3)"])
@pytest.mark.parametrize("text", ["0.125", "1.005", "NaN", "Infinity"])
def test_amounts_that_would_be_rounded_fail(spark, kind, text):
    from tidemark.functions.scalars import cents, money, money_sum

    if kind != "double" and not text[0].isdigit():
        pytest.skip("decimals are numbers")
    frame = spark.range(1).select(F.lit(text).cast(kind).alias("v"))
    for column in (money("v"), cents("v"), money_sum("v")):
        with pytest.raises(Exception, match="not an amount with 2 decimals"):
            frame.select(column).collect()


def test_money_and_cents_agree(spark):
    from tidemark.functions.scalars import cents, money

    frame = spark.createDataFrame([(2999.9799999999996,), (0.1 + 0.2,), (-1.15,), (123456789012.37,), (None,)], "v double")
    got = [(r[0], r[1]) for r in frame.select(money("v"), cents("v")).collect()]
    assert [c for _, c in got] == [299998, 30, -115, 12345678901237, None]
    assert all(m is None and c is None or int(m * 100) == c for m, c in got)


def test_bronze_keeps_resent_rows(spark, tmp_path):
    from tidemark.plans.retail_etl import append_bronze

    path = str(tmp_path / "bronze")
    for ids, batch in ((range(15), "a"), ([3], "b"), ([3], "b")):
        append_bronze(spark.createDataFrame([(i,) for i in ids], "id int"), path, batch)
    assert spark.read.parquet(path).count() == 16
