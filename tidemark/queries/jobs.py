"""Quality gates, layered tables and the three end-to-end jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.scalars import money_sum
from tidemark.operators.quality import Ref, Rule, dead_letter_rate, profile, reconcile, split_bad, tag
from tidemark.operators.windows import latest
from tidemark.plans import customer_360 as c360
from tidemark.plans import retail_etl
from tidemark.queries._registry import query
from tidemark.session import scratch_path

_RULES_SQL = """
    WITH judged AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             NOT coalesce(nullif(o_totalprice, 0) > 5000, FALSE) AS cheap, c_custkey IS NULL AS orphan
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0)
"""


def _rules():
    """A missing amount (here: zero) must count as bad."""
    return [Rule("amount_too_small", F.nullif("o_totalprice", F.lit(0.0)) > 5000)]


def _refs(t):
    return [Ref("unknown_customer", "o_custkey", t.customer.filter("c_acctbal > 0"), "c_custkey")]


@query(_RULES_SQL + """
    SELECT count(*) AS row_count, count(*) FILTER (WHERE cheap) AS amount_too_small,
           count(*) FILTER (WHERE orphan) AS unknown_customer FROM judged
""")
def gate_report(t):
    return profile(t.orders, _rules(), _refs(t))


@query(_RULES_SQL + """
    SELECT o_orderkey, o_custkey, o_totalprice,
           concat_ws(',', CASE WHEN cheap THEN 'amount_too_small' END, CASE WHEN orphan THEN 'unknown_customer' END)
             AS reasons
    FROM judged WHERE cheap OR orphan
""")
def dead_letter(t):
    _, dead = split_bad(t.orders, _rules(), _refs(t))
    return dead.select("o_orderkey", "o_custkey", "o_totalprice", F.array_join("reasons", ",").alias("reasons"))


@query(_RULES_SQL + """
    SELECT o_orderpriority, count(*) AS row_count, count(*) FILTER (WHERE cheap OR orphan) AS dead_count,
           CAST(count(*) FILTER (WHERE cheap OR orphan) AS DOUBLE) / count(*) AS dead_rate,
           CAST(count(*) FILTER (WHERE cheap OR orphan) AS DOUBLE) / count(*) > 0.1 AS alert
    FROM judged GROUP BY 1
""", name="dead_letter_rate")
def dead_letter_rate_query(t):
    return dead_letter_rate(tag(t.orders, _rules(), _refs(t)), ["o_orderpriority"], 0.1)


@query(_RULES_SQL + """
    SELECT count(*) AS bronze_rows, count(*) FILTER (WHERE NOT (cheap OR orphan)) AS silver_rows,
           count(*) FILTER (WHERE cheap OR orphan) AS dead_rows, TRUE AS balanced FROM judged
""")
def reconcile_layers(t):
    good, dead = split_bad(t.orders, _rules(), _refs(t))
    return reconcile(t.orders, good, dead)


@query("""
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 5000
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def silver_orders(t):
    """Checked orders, the newest per customer and status."""
    good, _ = split_bad(t.orders, _rules())
    newest = latest(good, ["o_custkey", "o_orderstatus"], ["o_orderdate"], ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


_GOLD = """
    SELECT {cols}, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, COUNT(*) AS order_count
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE o_totalprice > 5000 AND c_acctbal > 0 GROUP BY {by}
"""


def _gold(t, by: list[str]):
    """Revenue of orders checked against customers in credit, per account attribute.

    Places are a few rows; the planner sees their size and broadcasts them.
    """
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region")
    )
    accounts = t.customer.join(places, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), "region",
    )
    rules = [Rule("amount_too_small", F.col("o_totalprice") > 5000)]
    return retail_etl.totals_by_account(t.orders, accounts, rules, _refs(t), ["o_custkey"], by, "o_totalprice")


@query(_GOLD.format(cols="r_name AS region", by="1"))
def gold_region(t):
    return _gold(t, ["region"])


@query(_GOLD.format(cols="c_mktsegment AS segment", by="1"))
def gold_segment(t):
    return _gold(t, ["segment"])


@query(_GOLD.format(cols="o_custkey, c_name AS name", by="1, 2"))
def gold_customer(t):
    return _gold(t, ["o_custkey", "name"])


@query("""
    WITH judged AS (
      SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment,
             o_totalprice > 5000 AND c_custkey IS NOT NULL AS good
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0)
    SELECT 'bronze' AS layer, 'all' AS part, count(*) AS row_count,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
    UNION ALL SELECT CASE WHEN good THEN 'silver' ELSE 'dead' END, 'all', count(*),
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM judged GROUP BY good
    UNION ALL SELECT 'gold', c_mktsegment, count(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
           FROM judged WHERE good GROUP BY c_mktsegment
""")
def retail_layers(t):
    """The retail job with its tables written: the second run of a batch replaces the first."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    known = t.customer.filter("c_acctbal > 0")
    accounts = known.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    out = scratch_path(t.spark, "retail")
    for _ in range(2):
        made = retail_etl.run_tables(
            t.spark, orders, accounts, out, _rules()[:1], [Ref("unknown_customer", "o_custkey", known, "c_custkey")],
            ["o_custkey"], {"segment": ["segment"]}, "o_totalprice", "2024-01-01",
        )
    layers = [
        frame.agg(
            F.lit(name).alias("layer"), F.lit("all").alias("part"), F.count(F.lit(1)).alias("row_count"),
            money_sum("o_totalprice").alias("total"),
        )
        for name, frame in (("bronze", made.bronze), ("silver", made.silver), ("dead", made.dead))
    ]
    gold = made.gold["segment"].select(
        F.lit("gold").alias("layer"), F.col("segment").alias("part"), F.col("order_count").alias("row_count"),
        F.col("total_amount").alias("total"),
    )
    return layers[0].unionByName(layers[1]).unionByName(layers[2]).unionByName(gold)


@query("""
    SELECT '2024-01-01' AS batch, count(*) AS row_count, count(*) AS stamped FROM orders
    UNION ALL SELECT '2024-01-02', count(*), count(*) FROM orders WHERE o_orderkey % 15 = 1
""")
def bronze_append(t):
    """A batch and a re-send of some of its orders: bronze keeps both, a repeated run of either adds nothing."""
    path = scratch_path(t.spark, "bronze")
    again = t.orders.filter("o_orderkey % 15 = 1")
    for rows, batch in ((t.orders, "2024-01-01"), (again, "2024-01-02"), (again, "2024-01-02")):
        retail_etl.append_bronze(rows, path, batch)
    bronze = t.spark.read.parquet(path).groupBy(F.col("ingest_batch").cast("string").alias("batch"))
    return bronze.agg(F.count(F.lit(1)).alias("row_count"), F.count("ingested_at").alias("stamped"))


@query("""
    WITH dim AS (SELECT c_custkey AS cust_id, c_mktsegment AS tier, DATE '1995-01-01' AS s,
                        CASE WHEN c_acctbal > 4000 THEN DATE '1998-06-01' END AS e FROM customer
                 UNION ALL SELECT c_custkey, 'PREMIUM', DATE '1998-06-01', NULL FROM customer
                 WHERE c_acctbal > 4000)
    SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS day,
           tier AS tier_at_order
    FROM orders LEFT JOIN dim ON o_custkey = cust_id AND CAST(o_orderdate AS DATE) >= s
      AND (e IS NULL OR CAST(o_orderdate AS DATE) < e)
""")
def customer_360(t):
    """Two dimension states, facts loaded in overlapping batches, tiers as they were."""
    start = t.customer.select(
        F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("tier"),
        F.lit("1995-01-01").cast("date").alias("effective_start"), F.lit(None).cast("date").alias("effective_end"),
        F.lit(True).alias("is_current"),
    )
    upgrades = t.customer.filter("c_acctbal > 4000").select(
        F.col("c_custkey").alias("cust_id"), F.lit("PREMIUM").alias("tier")
    )
    dim = c360.next_dimension(start, upgrades, ["cust_id"], ["tier"], dt.date(1998, 6, 1))
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"),
        F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("day"),
    )
    facts = c360.load_facts(orders.filter("day < DATE '1999-01-01'"), orders.filter("day >= DATE '1998-01-01'"),
                            ["order_id"])
    return c360.view(facts, dim, ["cust_id"], "day", {"tier": "tier_at_order"})
