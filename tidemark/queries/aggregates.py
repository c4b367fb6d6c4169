"""Aggregations."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions.scalars import cents, exact_sum, money_avg, money_sum
from tidemark.operators.sketches import distinct_from_sketches, error_bound, replace_sketches, store_sketches
from tidemark.queries._registry import query
from tidemark.session import scratch_path


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS row_count,
           CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
           CAST(round(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2)
                AS DOUBLE) AS revenue,
           CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_qty
    FROM lineitem GROUP BY 1, 2
""")
def group_stats(t):
    # Cents times hundredths: whole numbers of a hundredth of a cent.
    net = exact_sum(cents("l_extendedprice") * (100 - cents("l_discount")))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        money_sum("l_quantity").alias("sum_qty"),
        money_sum("l_extendedprice").alias("sum_price"),
        F.round(net * F.lit(Decimal("0.0001")), 2).cast("double").alias("revenue"),
        money_avg("l_quantity").alias("avg_qty"),
    )


@query("""
    SELECT l_suppkey, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
           CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship
    FROM lineitem GROUP BY 1
""")
def group_minmax(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
        F.min("l_shipdate").cast("date").alias("first_ship"),
        F.max("l_shipdate").cast("date").alias("last_ship"),
    )


@query("""
    SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           count(*) AS orders, max(o_totalprice) AS highest, CAST(avg(o_custkey) AS DOUBLE) AS avg_custkey
    FROM orders GROUP BY 1
""")
def group_shorthand(t):
    orders = t.orders.withColumn("price", cents("o_totalprice").cast("decimal(18,0)"))
    return (
        orders.groupBy("o_orderstatus")
        .agg({"price": "sum", "*": "count", "o_totalprice": "max", "o_custkey": "avg"})
        .select(
            "o_orderstatus",
            (F.col("sum(price)").cast("double") / 100).alias("total"),
            F.col("count(1)").alias("orders"),
            F.col("max(o_totalprice)").alias("highest"),
            F.col("avg(o_custkey)").alias("avg_custkey"),
        )
    )


@query("""
    SELECT count(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           min(o_totalprice) AS lowest, max(o_totalprice) AS highest
    FROM orders
""")
def global_agg(t):
    return t.orders.agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum("o_totalprice").alias("total"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )


@query("""
    SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1
""")
def distinct_count(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))


@query()
def approx_distinct(t):
    return t.events.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("approx_users"))


@query("""
    SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS within_bound FROM events GROUP BY 1
""")
def approx_distinct_bound(t):
    """The sketch next to the exact count: off by at most three standard errors.

    Duplicates go first: beside an exact distinct count, Spark would carry a sketch of its own (3 kB) for every user.
    """
    users = t.events.select("event_type", "user_id").distinct()
    estimate = F.approx_count_distinct("user_id", 0.02)
    return (
        users.groupBy("event_type")
        .agg(F.count("user_id").alias("users"), estimate.alias("estimate"))
        .select("event_type", "users", (F.abs(F.col("estimate") - F.col("users")) <= 0.06 * F.col("users") + 1)
                .alias("within_bound"))
    )


@query("""
    WITH e AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day FROM events)
    SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS within_bound FROM e GROUP BY 1
    UNION ALL SELECT 'all', count(DISTINCT user_id), TRUE FROM e
""")
def distinct_from_days(t):
    """Distinct users from sketches stored per day and type: all days but the last, the last one added, then again.

    Next to the exact count: off by at most four standard errors.
    """
    path = scratch_path(t.spark, "sketches")
    events = t.events.select("event_type", "user_id", F.to_date("ts").alias("day"))
    last = events.agg(F.max("day").alias("day")).first()["day"]
    store_sketches(events.filter(F.col("day") < F.lit(last)), path, ["day", "event_type"], "user_id")
    for _ in range(2):
        replace_sketches(events.filter(F.col("day") == F.lit(last)), path, ["day", "event_type"], "user_id", [last])
    everyone = F.lit("all").alias("event_type")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    exact = exact.unionByName(events.agg(F.count_distinct("user_id").alias("users")).select(everyone, "users"))
    estimate = distinct_from_sketches(t.spark, path, ["event_type"])
    estimate = estimate.unionByName(distinct_from_sketches(t.spark, path).select(everyone, "estimate"))
    off = F.abs(F.col("estimate") - F.col("users"))
    return exact.join(estimate, "event_type").select(
        "event_type", "users", (off <= error_bound(4) * F.col("users") + 1).alias("within_bound")
    )


@query("""
    SELECT o_custkey, count(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1 HAVING count(*) > 12
""")
def having_count(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("total"))
        .filter(F.col("orders") > 12)
    )


@query("""
    SELECT p_brand, count(*) AS parts, count(nullif(p_size, 1)) AS sized,
           CAST(sum(CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN NULL ELSE nullif(p_size, 1) END) AS BIGINT)
             AS total,
           CAST(sum(nullif(p_size, 1)) AS DOUBLE) / count(nullif(p_size, 1)) AS mean
    FROM part GROUP BY 1
""")
def agg_null_rules(t):
    """NULL is skipped, and the sum of nothing is NULL."""
    size = F.nullif("p_size", F.lit(1))
    return t.part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"),
        F.count(size).alias("sized"),
        F.sum(F.when(~F.col("p_brand").isin("Brand#1", "Brand#2"), size)).alias("total"),
        F.avg(size).alias("mean"),
    )


@query("SELECT p_brand, count(*) AS parts FROM part WHERE p_size > 1000 GROUP BY 1")
def agg_empty_group(t):
    return t.part.filter("p_size > 1000").groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


@query("""
    SELECT p_brand, count(*) AS parts FROM part WHERE p_size > 48 AND p_brand < 'Brand#3' GROUP BY 1
""")
def agg_some_groups(t):
    """The twin with rows: groups without any are missing, the others counted."""
    some = t.part.filter((F.col("p_size") > 48) & (F.col("p_brand") < "Brand#3"))
    return some.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


@query("""
    WITH per AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
         seg AS (SELECT c_mktsegment, CAST(sum(n) AS DOUBLE) / count(*) AS avg_orders
                 FROM per JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT c_custkey, c_mktsegment, n AS orders, avg_orders
    FROM per JOIN customer ON o_custkey = c_custkey JOIN seg USING (c_mktsegment) WHERE n > avg_orders
""")
def above_avg_counts(t):
    """Customers ordering more often than their segment's average."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    counted = per.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    mean = counted.groupBy("c_mktsegment").agg(F.avg("orders").alias("avg_orders"))
    return counted.join(mean, "c_mktsegment").filter("orders > avg_orders")
