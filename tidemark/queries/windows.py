"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import money
from tidemark.operators.windows import (
    Split,
    gaps,
    lag_lead,
    latest,
    moving,
    ranks,
    running,
    top_n,
    with_totals,
    within,
    zscore,
)
from tidemark.queries._registry import query


@query("""
    SELECT p_brand, p_partkey, p_size,
           row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS row_number,
           rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rank,
           dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS dense_rank
    FROM part
""")
def rank_trio(t):
    parts = t.part.select("p_brand", "p_partkey", "p_size")
    return ranks(parts, ["p_brand"], ["-p_size"], ["p_partkey"])


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")


@query("""
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
                ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM orders
""")
def running_total(t):
    found = running(_orders(t), ["o_custkey"], ["day"], {"running": money("o_totalprice")}, tie=["o_orderkey"])
    return found.withColumn("running", F.col("running").cast("double"))


@query("""
    SELECT o_orderkey, o_orderpriority,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority
                ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM orders
""")
def running_total_hot(t):
    """Five keys share all rows, so each is cut into chunks."""
    orders = t.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    found = running(
        orders, ["o_orderpriority"], ["day"], {"running": money("o_totalprice")}, ["o_orderkey"], Split(1_000, 16)
    )
    return found.select("o_orderkey", "o_orderpriority", F.col("running").cast("double").alias("running"))


@query("""
    SELECT event_id, user_id,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING)
""")
def moving_avg(t):
    value = money("value")
    found = moving(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts"], ["event_id"], 3,
        {"__s": F.sum(value), "__n": F.count(value)},
    )
    mean = F.col("__s").cast("double") / F.col("__n").cast("double")
    return found.select("event_id", "user_id", mean.alias("moving_avg"))


@query("""
    SELECT c_custkey, c_mktsegment, c_acctbal,
           CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_mktsegment) AS DOUBLE) AS total,
           c_acctbal / CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_mktsegment) AS DOUBLE) AS share
    FROM customer
""")
def share_of_total(t):
    found = with_totals(t.customer, ["c_mktsegment"], {"total": F.sum(money("c_acctbal"))})
    total = F.col("total").cast("double")
    return found.select(
        "c_custkey", "c_mktsegment", "c_acctbal", total.alias("total"),
        F.try_divide(F.col("c_acctbal"), total).alias("share"),
    )


@query("""
    SELECT o_orderkey, o_custkey, lag(o_totalprice) OVER w AS previous,
           o_totalprice - lag(o_totalprice) OVER w AS change, lag(o_totalprice, 2, 0) OVER w AS two_back
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
""")
def lag_change(t):
    found = lag_lead(
        _orders(t), ["o_custkey"], ["day"], ["o_orderkey"],
        lags={"previous": ("o_totalprice", 1, None), "two_back": ("o_totalprice", 2, 0.0)},
    )
    return found.select(
        "o_orderkey", "o_custkey", "previous", (F.col("o_totalprice") - F.col("previous")).alias("change"), "two_back"
    )


@query("""
    SELECT o_orderkey, o_orderstatus, lead(o_orderkey) OVER w AS next_order,
           lag(o_orderkey, 3, -1) OVER w AS third_before
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
""")
def lead_next(t):
    """Three statuses hold all orders; neighbours are lent across chunk borders."""
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    found = lag_lead(
        orders, ["o_orderstatus"], ["day"], ["o_orderkey"],
        lags={"third_before": ("o_orderkey", 3, -1)}, leads={"next_order": ("o_orderkey", 1, None)},
        split=Split(1_000, 16),
    )
    return found.select("o_orderkey", "o_orderstatus", "next_order", "third_before")


@query("""
    WITH d AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day,
                      lag(CAST(o_orderdate AS DATE)) OVER w AS prev, lead(CAST(o_orderdate AS DATE)) OVER w AS nxt
               FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey))
    SELECT o_orderkey, o_custkey, day, CAST(date_diff('day', prev, day) AS INTEGER) AS days_since_previous,
           CAST(date_diff('day', day, nxt) AS INTEGER) AS days_until_next FROM d
""")
def gap_analysis(t):
    return gaps(_orders(t).drop("o_totalprice"), ["o_custkey"], "day", ["o_orderkey"])


@query("""
    WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day,
                      lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS prev
               FROM orders)
    SELECT o_custkey, CAST(max(date_diff('day', prev, day)) AS INTEGER) AS longest FROM d GROUP BY 1
""")
def gap_longest(t):
    found = gaps(_orders(t).drop("o_totalprice"), ["o_custkey"], "day", ["o_orderkey"])
    return found.groupBy("o_custkey").agg(F.max("days_since_previous").alias("longest"))


@query("""
    SELECT o_orderkey, o_orderpriority,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority
                ORDER BY CAST(o_orderdate AS DATE)) AS DOUBLE) AS running
    FROM orders
""")
def range_default(t):
    """No frame given: orders of one day share the running total."""
    orders = t.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    found = running(orders, ["o_orderpriority"], ["day"], {"running": money("o_totalprice")})
    return found.select("o_orderkey", "o_orderpriority", F.col("running").cast("double").alias("running"))


@query("""
    SELECT o_orderkey, o_orderpriority,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS week_total,
           count(*) OVER w AS week_orders
    FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day_no FROM orders)
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day_no RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def range_within_7d(t):
    orders = t.orders.select(
        "o_orderkey", "o_orderpriority", F.unix_date(F.to_date("o_orderdate")).alias("day_no"), "o_totalprice"
    )
    found = within(
        orders, ["o_orderpriority"], "day_no", 6,
        {"week_total": money("o_totalprice"), "week_orders": F.lit(1).cast("bigint")}, Split(1_000, 16),
    )
    return found.select(
        "o_orderkey", "o_orderpriority", F.col("week_total").cast("double").alias("week_total"), "week_orders"
    )


@query("""
    SELECT p_brand, p_partkey, p_retailprice,
           CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER)
             AS row_number
    FROM part QUALIFY row_number <= 3
""", name="top_n")
def top_n_query(t):
    return top_n(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], ["-p_retailprice"], 3,
                 ["p_partkey"])


@query("""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest(t):
    return latest(t.events, ["user_id"], ["ts"], ["event_id"]).select("user_id", "event_id", "event_type", "value")


_Z = """
    SELECT event_id, event_type,
           round((v - avg(v) OVER (PARTITION BY event_type)) / stddev_samp(v) OVER (PARTITION BY event_type), 6) + 0.0
             AS z
    FROM (SELECT event_id, event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS v FROM events)
"""


def _nullable_values(t):
    value = F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("value"))
    return t.events.select("event_id", "event_type", value.alias("v"))


@query(_Z)
def zscore_native(t):
    found = zscore(_nullable_values(t), ["event_type"], "v")
    return found.select("event_id", "event_type", (F.round("z", 6) + F.lit(0.0)).alias("z"))


@query("""
    SELECT event_id, user_id, CASE WHEN v IS NOT NULL THEN
             rank() OVER (PARTITION BY user_id ORDER BY v DESC NULLS LAST) END AS position
    FROM (SELECT event_id, user_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS v FROM events)
""")
def rank_nullable(t):
    """A missing value has no rank."""
    value = F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("value"))
    events = t.events.select("event_id", "user_id", value.alias("v"))
    found = ranks(events, ["user_id"], ["-v"], ["event_id"])
    return found.select(
        "event_id", "user_id", F.when(F.col("v").isNotNull(), F.col("rank")).alias("position")
    )
