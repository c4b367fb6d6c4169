"""Skew measurement and two-stage aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import money
from tidemark.operators.layout import co_locate, reused, spread
from tidemark.operators import skew
from tidemark.operators.skew import hot_keys, key_skew, partition_balance, salted_agg
from tidemark.queries._registry import query


def _skewed(t):
    key = F.when(F.col("user_id") % 10 != 0, F.lit(-1).cast("bigint")).otherwise(F.col("user_id"))
    return t.events.select("event_id", key.alias("key"), "value")


_SKEWED = "WITH e AS (SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN -1 ELSE user_id END AS key, value FROM events)"


@query(_SKEWED + """
    SELECT key, count(*) AS rows_seen, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           min(value) AS lowest, max(value) AS highest,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
    FROM e GROUP BY 1
""", name="salted_agg")
def salted_agg_query(t):
    value = money("value")
    return salted_agg(
        _skewed(t), ["key"], ["event_id"], salts=8,
        sums={"total": value}, counts={"rows_seen": F.lit(1)}, mins={"lowest": "value"}, maxs={"highest": "value"},
        avgs={"mean": value},
    ).withColumn("total", F.col("total").cast("double"))


@query(_SKEWED + """
    SELECT key, count(*) AS row_count, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) AS share
    FROM e GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""", name="key_skew")
def key_skew_query(t):
    return key_skew(_skewed(t), ["key"], 10)


@query(_SKEWED + "SELECT key FROM e GROUP BY 1 HAVING count(*) > 0.05 * (SELECT count(*) FROM events)", name="hot_keys")
def hot_keys_query(t):
    return hot_keys(_skewed(t), ["key"], 0.05)


@query()
def partition_profile(t):
    """Rows per partition before and after salting, as largest and median."""
    events = _skewed(t)
    plain = partition_balance(co_locate(events, ["key"], 16)).withColumn("layout", F.lit("by key"))
    salt = F.pmod(F.xxhash64("event_id"), F.lit(8)).alias("salt")
    salted = partition_balance(co_locate(events.select("*", salt), ["key", "salt"], 16))
    return plain.unionByName(salted.withColumn("layout", F.lit("by key and salt")))


@query(_SKEWED + """
    SELECT layout, (SELECT count(*) FROM e) AS row_count, layout = 'by key' AS one_partition_holds_the_key
    FROM (VALUES ('by key'), ('by key and salt')) v(layout)
""")
def partition_invariants(t):
    """Largest partition before and after salting: first the whole largest key, then less than half of it."""
    events = _skewed(t)
    salted = events.withColumn("salt", F.pmod(F.xxhash64("event_id"), F.lit(8)))
    largest_key = key_skew(events, ["key"], 1).select("row_count").scalar()
    found = [
        skew.partition_profile(co_locate(rows, keys, 16))
        .agg(F.sum("row_count").alias("row_count"), F.max("row_count").alias("largest"))
        .select(
            F.lit(layout).alias("layout"),
            "row_count",
            F.when(F.col("largest") >= largest_key, True).when(F.col("largest") < largest_key / 2, False)
            .alias("one_partition_holds_the_key"),
        )
        for layout, rows, keys in (("by key", events, ["key"]), ("by key and salt", salted, ["key", "salt"]))
    ]
    return found[0].unionByName(found[1])


@query("""
    SELECT 'spread' AS layout, 8 AS partitions, count(*) AS row_count FROM events
    UNION ALL SELECT 'by user', 8, count(*) FROM events
""")
def partition_rows(t):
    """Round-robin and hash layouts: the rows of all partitions add up to the table, whatever the split."""
    layouts = {"spread": spread(t.events, 8), "by user": co_locate(t.events, ["user_id"], 8)}
    found = [
        skew.partition_profile(df).agg(
            F.lit(name).alias("layout"), F.lit(8).alias("partitions"),
            F.sum("row_count").alias("row_count"),
        )
        for name, df in layouts.items()
    ]
    return found[0].unionByName(found[1])


@query("""
    SELECT user_id, count(*) AS events, max(value) AS highest,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases
    FROM events GROUP BY 1
""")
def one_shuffle_many_steps(t):
    """Hash partitions by key serve two groupings and their join."""
    events = co_locate(t.events, ["user_id"])
    totals = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.max("value").alias("highest"))
    bought = events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.count(F.lit(1)).alias("purchases"))
    return totals.join(bought, "user_id", "left").na.fill({"purchases": 0})


@query("SELECT count(*) AS row_count, max(value) AS highest FROM events WHERE event_type = 'purchase'")
def reuse_branch(t):
    """A branch that two actions read is kept between them and released."""
    with reused(t.events.filter("event_type = 'purchase'").select("value")) as kept:
        count, highest = kept.count(), kept.agg(F.max("value")).first()[0]
    return t.spark.createDataFrame([(count, highest)], "row_count bigint, highest double")
