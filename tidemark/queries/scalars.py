"""Scalar functions, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import money, sort_columns
from tidemark.operators.windows import Split, global_top, ranks
from tidemark.queries._registry import query


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity + 1 AS plus, l_quantity - l_discount AS minus,
           l_extendedprice / nullif(l_quantity, 0) AS unit_price,
           l_extendedprice / nullif(l_discount, 0) AS per_discount,
           l_orderkey % 7 AS rest, sqrt(l_quantity) AS root, CAST(floor(l_extendedprice) AS BIGINT) AS whole,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
           (l_tax >= 0.05) AS taxed_high, (l_tax >= 0.05 AND NOT (l_discount = 0)) AS both
    FROM lineitem
""")
def scalar_math(t):
    quantity, price, discount = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (quantity + 1).alias("plus"),
        (quantity - discount).alias("minus"),
        F.try_divide(price, quantity).alias("unit_price"),
        F.try_divide(price, discount).alias("per_discount"),
        F.try_mod("l_orderkey", F.lit(7).cast("bigint")).alias("rest"),
        F.sqrt(quantity).alias("root"),
        F.floor(price).alias("whole"),
        F.round(money("l_extendedprice"), 1).cast("double").alias("rounded"),
        (F.col("l_tax") >= 0.05).alias("taxed_high"),
        ((F.col("l_tax") >= 0.05) & ~(discount == 0)).alias("both"),
    )


@query("""
    SELECT p_partkey, upper(p_name) AS loud, split_part(p_name, ' ', 1) AS first_word,
           CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS brand_no,
           concat_ws('|', p_brand, p_type, nullif(p_name, 'cold widget')) AS label
    FROM part
""")
def scalar_string(t):
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("loud"),
        F.split("p_name", " ")[0].alias("first_word"),
        F.regexp_extract("p_brand", "[0-9]+", 0).cast("int").alias("brand_no"),
        F.concat_ws("|", "p_brand", "p_type", F.nullif("p_name", F.lit("cold widget"))).alias("label"),
    )


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_no,
           CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due
    FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-06-01'
""")
def scalar_date(t):
    day = F.to_date("o_orderdate")
    return t.orders.filter(F.col("o_orderdate") >= F.lit("1996-06-01").cast("timestamp_ntz")).select(
        "o_orderkey",
        F.year("o_orderdate").alias("order_year"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("day_no"),
        F.date_add(day, 30).alias("due"),
    )


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k_text,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
           json_extract_string(props, '$.missing') AS missing
    FROM events
""")
def scalar_json(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", "k int")["k"].alias("k_int"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


@query("""
    SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100
""")
def sort_limit(t):
    return (
        t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
        .orderBy(*sort_columns(["o_orderpriority", "-o_totalprice", "o_orderkey"]))
        .limit(100)
    )


@query("""
    SELECT p_brand, p_partkey, nullif(p_size, 1) AS size,
      CAST(row_number() OVER (PARTITION BY p_brand ORDER BY nullif(p_size, 1) ASC NULLS FIRST, p_partkey) AS INTEGER)
        AS asc_first,
      CAST(row_number() OVER (PARTITION BY p_brand ORDER BY nullif(p_size, 1) DESC NULLS LAST, p_partkey) AS INTEGER)
        AS desc_last
    FROM part
""")
def sort_nulls(t):
    """Positions under explicit null placement."""
    parts = t.part.select("p_brand", "p_partkey", F.nullif("p_size", F.lit(1)).alias("size"))
    split = Split(1_000, 16)

    def position(order, name):
        return ranks(parts, ["p_brand"], [order], ["p_partkey"], split).select(
            "p_brand", "p_partkey", "size", F.col("row_number").cast("int").alias(name)
        )

    up, down = position("size", "asc_first"), position("-size", "desc_last")
    return up.join(down.select("p_partkey", "desc_last"), "p_partkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(*sort_columns(["-o_totalprice", "o_orderkey"])).limit(25)


@query("""
    SELECT o_orderkey, o_totalprice,
           CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS row_number
    FROM orders QUALIFY row_number <= 50
""")
def global_topk(t):
    return global_top(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice"], 50, ["o_orderkey"])


@query("SELECT s_nationkey, s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1")
def top_one(t):
    return t.supplier.orderBy(*sort_columns(["-s_acctbal", "s_suppkey"])).select("s_nationkey", "s_suppkey").limit(1)
