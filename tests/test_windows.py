"""Window operators: split keys must give what plain windows give."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.fixtures import orders, plan_of, rows, staff
from tidemark.operators import windows as ops
from tidemark.operators.joins import pit_join
from tidemark.operators.windows import Split

SPLITS = [Split(20, 12), Split(1, 500)]


def skewed(spark, seed=1, n=300):
    """A third of the rows under one key, a third under NULL, ties and NULLs in order and value."""
    r = random.Random(seed)
    data = []
    for i in range(n):
        key = ["hot", None, f"k{r.randrange(20)}"][i % 3]
        at = None if r.random() < 0.05 else r.randrange(40)
        value = None if r.random() < 0.1 else r.randrange(100)
        data.append((i, key, at, value))
    return spark.createDataFrame(data, "id int, key string, at int, value int")


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """These many tiny plans take longer to compile than to run."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def frame(spark):
    return skewed(spark).persist()


def by_order(order):
    return Window.partitionBy("key").orderBy(*order)


def up():
    return F.col("at").asc_nulls_first()


def down():
    return F.col("at").desc_nulls_last()


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("lead,col", [("at", up), ("-at", down)])
def test_running_rows(frame, split, lead, col):
    w = by_order([col(), "id"]).rowsBetween(Window.unboundedPreceding, 0)
    want = frame.withColumn("total", F.sum("value").over(w))
    got = ops.running(frame, ["key"], [lead], {"total": "value"}, ["id"], split)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("split", SPLITS)
def test_running_range_shares_total_between_peers(frame, split):
    want = frame.withColumn("total", F.sum("value").over(by_order([up()])))
    assert rows(ops.running(frame, ["key"], ["at"], {"total": "value"}, split=split)) == rows(want)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("lead,col", [("at", up), ("-at", down)])
def test_ranks(frame, split, lead, col):
    want = frame.withColumns(
        {
            "row_number": F.row_number().over(by_order([col(), "id"])),
            "rank": F.rank().over(by_order([col()])),
            "dense_rank": F.dense_rank().over(by_order([col()])),
        }
    )
    assert rows(ops.ranks(frame, ["key"], [lead], ["id"], split)) == rows(want)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("lead,col", [("at", up), ("-at", down)])
def test_lag_lead(frame, split, lead, col):
    w = by_order([col(), "id"])
    want = frame.withColumns(
        {"a": F.lag("value").over(w), "b": F.lag("id", 5, -1).over(w), "c": F.lead("value", 2).over(w)}
    )
    got = ops.lag_lead(
        frame, ["key"], [lead], ["id"],
        lags={"a": ("value", 1, None), "b": ("id", 5, -1)}, leads={"c": ("value", 2, None)}, split=split,
    )
    assert rows(got) == rows(want)


@pytest.mark.parametrize("split", SPLITS)
def test_moving(frame, split):
    w = by_order([up(), "id"]).rowsBetween(-6, 0)
    want = frame.withColumns({"m": F.avg("value").over(w), "n": F.count("value").over(w)})
    got = ops.moving(frame, ["key"], ["at"], ["id"], 7, {"m": F.avg("value"), "n": F.count("value")}, split)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("width", [0, 3, 25])
def test_within(frame, split, width):
    w = by_order([up()]).rangeBetween(-width, 0)
    want = frame.withColumns({"s": F.sum("value").over(w), "n": F.sum(F.lit(1)).over(w)})
    got = ops.within(frame, ["key"], "at", width, {"s": "value", "n": F.lit(1)}, split)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("split", SPLITS)
def test_totals_and_zscore(frame, split):
    w = Window.partitionBy("key")
    want = frame.withColumns({"s": F.sum("value").over(w), "n": F.count("value").over(w)})
    assert rows(ops.with_totals(frame, ["key"], {"s": F.sum("value"), "n": F.count("value")}, split)) == rows(want)
    z = F.try_divide(F.col("value") - F.avg("value").over(w), F.stddev_samp("value").over(w))
    rounded = F.round("z", 9).alias("z")
    want_z = frame.withColumn("z", z).select("id", rounded)
    assert rows(ops.zscore(frame, ["key"], "value", "z", split).select("id", rounded)) == rows(want_z)


@pytest.mark.parametrize("split", SPLITS)
def test_asof_versions_equals_interval_join(spark, frame, split):
    from tidemark.operators.joins import pit_join

    r = random.Random(5)
    versions = []
    for key in ["hot", *(f"k{i}" for i in range(0, 20, 2))]:
        cuts = sorted(r.sample(range(40), 8))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if i % 3 != 2:  # leaves gaps
                versions.append((key, a, None if i == 6 else b, f"{key}-{i}"))
    dim = spark.createDataFrame(versions, "key string, effective_start int, effective_end int, tag string")
    facts = frame.filter("at IS NOT NULL")
    want = pit_join(facts, dim, ["key"], "at").select(*facts.columns, "tag")
    got = ops.asof_versions(facts, dim, ["key"], "at", ["tag"], split=split)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(10,2)", "double", "bigint"])
def test_leading_order_types(spark, kind):
    base = spark.range(200).withColumn("key", F.when(F.col("id") >= 0, "hot"))
    at = {
        "date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")),
        "timestamp": F.timestamp_seconds(F.col("id") * 777),
        "timestamp_ntz": F.timestamp_seconds(F.col("id") * 777).cast("timestamp_ntz"),
    }.get(kind, (F.col("id") * 3).cast(kind))
    df = base.withColumn("at", at)
    got = ops.ranks(df, ["key"], ["at"], ["id"], Split(10, 20)).select("id", "row_number")
    want = df.select("id", F.row_number().over(Window.partitionBy("key").orderBy("at", "id")).alias("row_number"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("kind", ["int", "decimal(12,2)", "string", "binary", "array", "struct", "boolean"])
def test_one_result_whatever_the_size(spark, kind):
    """Rows and schema of a split key equal those of a plain window for every type that sorts."""
    number = F.col("id") * 37 % 100
    text = F.concat(F.lit("a long shared prefix "), number.cast("string"))
    at = {
        "int": number.cast("int"), "decimal(12,2)": number.cast("decimal(12,2)"), "string": text,
        "binary": text.cast("binary"), "array": F.array(number, "id"), "struct": F.struct(number, F.col("id") % 3),
        "boolean": number % 2 == 0,
    }[kind]
    df = spark.range(300).select(
        "id", F.lit("all").alias("key"), at.alias("at"), F.col("id").cast("decimal(18,2)").alias("money")
    )
    split = Split(20, 16)
    calls = [
        lambda how: ops.ranks(df, ["key"], ["at"], ["id"], how),
        lambda how: ops.running(df, ["key"], ["at"], {"t": "money", "n": "id"}, ["id"], how),
        lambda how: ops.running(df, ["key"], ["at"], {"t": "money"}, split=how),
        lambda how: ops.lag_lead(df, ["key"], ["-at"], ["id"], {"p": ("id", 1, None)}, {"n": ("id", 2, None)}, how),
        lambda how: ops.with_totals(df, ["key"], {"s": F.sum("money")}, how),
        lambda how: ops.within(df, ["key"], "id", 7, {"s": "money"}, how),
    ]
    for call in calls:
        plain, cut = call(Split()), call(split)
        assert plain.schema.simpleString() == cut.schema.simpleString()
        assert rows(plain) == rows(cut)
    if kind not in ("boolean",):
        sizes = [r["count"] for r in ops.chunked(df, ["key"], ["at", "id"], split).hot.groupBy("__chunk").count().collect()]
        assert max(sizes) <= 60


def test_neighbours_of_one_crowded_day_are_spread(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") >= 0, 1).alias("key"), F.lit(5).alias("day"))
    split = Split(100, 64)
    sizes = [r["count"] for r in ops.chunked(df, ["key"], ["day", "id"], split).hot.groupBy("__chunk").count().collect()]
    assert max(sizes) < 400
    got = ops.lag_lead(df, ["key"], ["day"], ["id"], {"p": ("id", 1, None)}, split=split)
    assert got.filter("p = id - 1").count() == 1999


def test_full_width_window_does_not_multiply_rows(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") >= 0, 1).alias("key"), F.lit(1).alias("one"))
    got = ops.within(df, ["key"], "id", 10_000, {"n": "one"}, Split(100, 64))
    assert "sequence(" not in plan_of(got) and got.agg(F.max("n"), F.count("n")).first()[:] == (4000, 4000)


@pytest.mark.parametrize("lead", ["at", "-at"])
def test_text_order(spark, lead):
    r = random.Random(3)
    words = ["", "a", "ab", "abcdefgh", "abcdefgi", "zz", "Z", "\u00e9t\u00e9", "\u4e2d\u6587", None]
    data = [(i, "hot", r.choice(words)) for i in range(300)]
    df = spark.createDataFrame(data, "id int, key string, at string")
    order = F.col("at").desc_nulls_last() if lead[0] == "-" else F.col("at").asc_nulls_first()
    w = Window.partitionBy("key").orderBy(order, "id")
    want = df.withColumns({"row_number": F.row_number().over(w), "p": F.lag("id").over(w)})
    assert rows(ops.ranks(df, ["key"], [lead], ["id"], Split(20, 16)).select("id", "row_number")) == rows(
        want.select("id", "row_number")
    )
    got = ops.lag_lead(df, ["key"], [lead], ["id"], lags={"p": ("id", 1, None)}, split=Split(20, 16))
    assert rows(got.select("id", "p")) == rows(want.select("id", "p"))


@pytest.mark.parametrize("lead,tie", [("at", "-id"), ("-at", "id")])
def test_crowded_values_are_cut_again(spark, lead, tie):
    """Two values and NULL hold most rows of the hot key; each spreads over several chunks."""
    at = F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 11)
    key = F.when(F.col("id") % 10 != 9, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(3000).select("id", key.alias("key"), at.cast("int").alias("at"), (F.col("id") % 13).alias("value"))
    split = Split(100, 64)
    hot = ops.chunked(df, ["key"], [lead, tie], split).hot.filter("key = 'hot'")
    sizes = [r["count"] for r in hot.groupBy("__chunk").count().collect()]
    assert sum(sizes) == 2700 and max(sizes) < 350
    order = [F.col("at").desc_nulls_last() if lead[0] == "-" else F.col("at").asc_nulls_first(),
             F.col("id").desc() if tie[0] == "-" else F.col("id").asc()]
    w, peers = Window.partitionBy("key").orderBy(*order), Window.partitionBy("key").orderBy(order[0])
    want = df.withColumns({
        "row_number": F.row_number().over(w), "rank": F.rank().over(peers), "dense_rank": F.dense_rank().over(peers),
    })
    assert rows(ops.ranks(df, ["key"], [lead], [tie], split)) == rows(want)
    total = df.withColumn("t", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(ops.running(df, ["key"], [lead], {"t": "value"}, [tie], split)) == rows(total)
    near = df.withColumns({"a": F.lag("id", 2).over(w), "b": F.lead("id").over(w)})
    got = ops.lag_lead(df, ["key"], [lead], [tie], {"a": ("id", 2, None)}, {"b": ("id", 1, None)}, split)
    assert rows(got) == rows(near)


def test_partition_columns_are_required(frame):
    with pytest.raises(ValueError, match="partition"):
        ops.running(frame, [], ["at"], {"t": "value"})


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, key string, at int, value int")
    assert ops.ranks(df, ["key"], ["at"], ["id"]).count() == 0
    assert ops.running(df, ["key"], ["at"], {"t": "value"}).count() == 0


def test_rank_on_tied_amounts(spark):
    got = ops.ranks(orders(spark), ["category"], ["-amount"], ["order_id"]).filter("category = 'Electronics'")
    assert rows(got, "order_id", "row_number", "rank", "dense_rank") == [
        (1004, 3, 3, 2), (1006, 1, 1, 1), (1009, 4, 3, 2), (1011, 2, 1, 1), (1015, 5, 3, 2),
    ]


def test_rows_and_range_running_totals(spark):
    tied = spark.createDataFrame([(1, 250.0, 1), (2, 250.0, 1), (3, 250.0, 1)], "id int, amount double, g int")
    by_rows = ops.running(tied, ["g"], ["amount"], {"t": "amount"}, ["id"])
    assert rows(by_rows, "id", "t") == [(1, 250.0), (2, 500.0), (3, 750.0)]
    by_range = ops.running(tied, ["g"], ["amount"], {"t": "amount"})
    assert rows(by_range, "id", "t") == [(1, 750.0), (2, 750.0), (3, 750.0)]


def test_gaps(spark):
    got = ops.gaps(orders(spark).filter("emp_id = 5"), ["emp_id"], "order_date", ["order_id"])
    assert rows(got, "order_id", "days_since_previous", "days_until_next") == [
        (1003, None, 40), (1006, 40, 69), (1010, 69, 58), (1015, 58, None),
    ]


def test_top_n_is_exact_under_ties_and_pruned_before_the_shuffle(spark):
    top = ops.top_n(orders(spark), ["region"], ["-amount"], 1, ["order_id"])
    assert rows(top, "region", "order_id") == [("East", 1006), ("North", 1009), ("South", 1013), ("West", 1011)]
    plan = plan_of(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_n_limit_of_pruning(spark):
    with pytest.raises(ValueError, match="1000"):
        ops.top_n(orders(spark), ["region"], ["-amount"], 1001, ["order_id"])


def test_latest_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "a"), (1, dt.date(2024, 1, 2), "b"), (1, dt.date(2024, 1, 2), "c")],
        "id int, at date, tag string",
    )
    assert rows(ops.latest(df, ["id"], ["at"], ["tag"]), "tag") == [("c",)]


def test_global_top_never_sorts_everything_in_one_task(spark):
    top = ops.global_top(orders(spark), ["-amount"], 3, ["order_id"])
    assert rows(top, "order_id", "row_number") == [(1004, 3), (1006, 1), (1011, 2)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_zscore_null_rules(spark):
    got = ops.zscore(staff(spark), ["department"], "salary")
    by_name = {r["name"]: r["z"] for r in got.collect()}
    assert by_name["Mona Farouk"] is None
    assert by_name["Noah Bergstrom"] == pytest.approx(0.7071067811865475)
    single = ops.zscore(staff(spark).filter("emp_id = 1"), ["department"], "salary")
    assert rows(single, "z") == [(None,)]


def test_plain_window_for_a_small_table(frame):
    got = ops.running(frame, ["key", "id"], ["at"], {"t": "value"}, split=Split(1000, 4))
    assert "BroadcastHashJoin" not in plan_of(got)


def test_hot_rows_are_not_gathered_under_one_key(frame):
    """With cuts the window partitions by key and chunk."""
    got = ops.ranks(frame, ["key"], ["at"], ["id"], Split(20, 12))
    assert "__chunk" in plan_of(got)


@pytest.mark.parametrize("share", [0.009, 0.9])
def test_large_and_middling_keys_both_spread(spark, share):
    """Two million rows: a key with 90 % of them and one with 0.9 % get chunks of the same size."""
    total, own = 2_000_000, int(2_000_000 * share)
    key = F.when(F.col("id") < own, F.lit(-1)).otherwise(F.col("id"))
    big = spark.range(total).select(
        "id", key.alias("key"), (F.col("id") * 7919 % 1_000_003).alias("at"), F.lit(1).cast("bigint").alias("one")
    ).repartition(8, "id")
    split = Split(1, 1000)
    cut = ops.chunked(big, ["key"], ["at", "id"], split)
    sizes = [r["count"] for r in cut.df.groupBy("key", "__chunk").count().filter("key = -1").collect()]
    assert sum(sizes) == own and max(sizes) < 5 * total / 1000
    found = ops.running(big, ["key"], ["at"], {"n": "one"}, ["id"], split).filter("key = -1")
    assert found.agg(F.max("n"), F.count_distinct("n"), F.min("n")).first()[:] == (own, own, 1)


def test_one_job_while_planning(spark, frame):
    tracker = spark.sparkContext.statusTracker()
    split = Split(20, 12)
    calls = {
        "ranks": lambda: ops.ranks(frame, ["key"], ["at"], ["id"], split),
        "rows": lambda: ops.running(frame, ["key"], ["at"], {"t": "value"}, ["id"], split),
        "range": lambda: ops.running(frame, ["key"], ["at"], {"t": "value"}, split=split),
        "lag": lambda: ops.lag_lead(frame, ["key"], ["at"], ["id"], {"p": ("id", 1, None)}, split=split),
    }
    for name, call in calls.items():
        spark.sparkContext.setJobGroup(f"planning {name}", name)
        try:
            call()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # An adaptive query runs each of its stages as a job; they are one query here.
        calls[name] = len(tracker.getJobIdsForGroup(f"planning {name}"))
    assert max(calls.values()) <= 3, calls


def test_rows_are_lent_to_the_next_chunk_only(spark):
    """Frames far shorter than a chunk: each chunk gets just the rows before it, whatever the key's size."""
    df = spark.range(20_000).select("id", F.lit("all").alias("key"), F.col("id").alias("at")).repartition(4)
    rows_ = ops.chunked(df, ["key"], ["at"], Split(100, 40))
    lent = ops._halo(rows_, ["at"], 3, after=False)
    sizes = [r["count"] for r in lent.groupBy("__chunk").count().collect()]
    assert len(sizes) > 20 and set(sizes) == {3}
    behind = ops._halo(rows_, ["at"], 3, after=True)
    assert {r["count"] for r in behind.groupBy("__chunk").count().collect()} == {3}


def test_peers_parted_by_cuts_share_totals_and_ranks(spark):
    """One ordering value holds half of a key, so its peers lie in many chunks."""
    at = F.when(F.col("id") % 2 == 0, F.lit(50)).otherwise(F.col("id") % 100)
    df = spark.range(4000).select("id", F.lit(1).alias("key"), at.alias("at"), (F.col("id") % 7).alias("value")).persist()
    split = Split(50, 64)
    sizes = [r["count"] for r in ops.chunked(df, ["key"], ["at", "id"], split).hot.groupBy("__chunk").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 400
    w = Window.partitionBy("key").orderBy("at")
    want = df.withColumns({"t": F.sum("value").over(w), "c": F.count("value").over(w)})
    got = ops.running(df, ["key"], ["at"], {"t": "value", "c": F.lit(1).cast("bigint")}, split=split)
    assert rows(got) == rows(want)
    want = df.withColumns({"rank": F.rank().over(w), "dense_rank": F.dense_rank().over(w)})
    assert rows(ops.ranks(df, ["key"], ["at"], ["id"], split).drop("row_number")) == rows(want)


def test_small_tables_are_never_cut(frame):
    assert ops.chunked(frame, ["key"], ["at"], Split()).hot is None
    assert ops.chunked(frame, ["key"], ["at"], Split(20, 12)).hot is not None


def test_sketch_finds_every_hot_key(frame):
    from tidemark.operators.skew import heavy_hashes

    hashes, total = heavy_hashes(frame, ["key"], 0.2)
    assert total == 300 and sorted(hashes.values()) == [100, 100]
