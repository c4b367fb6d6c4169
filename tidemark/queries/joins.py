"""Joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import cents, exact_sum
from tidemark.operators.joins import broadcast_small, null_safe_join, orphans, pit_join, range_join
from tidemark.operators.skew import SALT, salted_join, salted_parts
from tidemark.operators.windows import Split, asof_versions
from tidemark.queries._registry import query
from tidemark.session import cut_lineage


def _orders(t):
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")


def _accepted(t):
    """Customers in credit; the others leave orders without a parent."""
    return t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")


_SIDES = """
    WITH o AS (SELECT o_orderkey, o_custkey AS custkey, o_totalprice FROM orders),
         c AS (SELECT c_custkey AS custkey, c_mktsegment FROM customer WHERE c_acctbal > 0),
         few AS (SELECT o_orderkey, o_custkey AS custkey, o_totalprice FROM orders WHERE o_totalprice > 300000)
"""


@query(_SIDES + "SELECT custkey, o_orderkey, o_totalprice, c_mktsegment FROM o JOIN c USING (custkey)")
def join_inner(t):
    return _orders(t).join(_accepted(t), "custkey", "inner")


@query(_SIDES + "SELECT custkey, o_orderkey, o_totalprice, c_mktsegment FROM o LEFT JOIN c USING (custkey)")
def join_left(t):
    return _orders(t).join(_accepted(t), "custkey", "left")


@query(_SIDES + """SELECT o.custkey, o_orderkey, o_totalprice FROM c RIGHT JOIN o ON c.custkey = o.custkey
                   WHERE c.custkey IS NULL""")
def join_right_orphans(t):
    parents = _accepted(t).withColumnRenamed("custkey", "parent")
    joined = parents.join(_orders(t), F.col("parent") == F.col("custkey"), "right")
    return joined.filter(F.col("parent").isNull()).select("custkey", "o_orderkey", "o_totalprice")


@query(_SIDES + "SELECT custkey, o_orderkey, o_totalprice FROM o ANTI JOIN c USING (custkey)")
def find_orphans(t):
    return orphans(_orders(t), _accepted(t), ["custkey"])


@query(_SIDES + """SELECT coalesce(few.custkey, c.custkey) AS custkey, o_orderkey, o_totalprice, c_mktsegment
                   FROM few FULL JOIN c ON few.custkey = c.custkey""")
def join_full(t):
    return _orders(t).filter("o_totalprice > 300000").join(_accepted(t), "custkey", "full")


@query(_SIDES + "SELECT custkey, c_mktsegment FROM c SEMI JOIN few USING (custkey)")
def join_semi(t):
    return _accepted(t).join(_orders(t).filter("o_totalprice > 300000"), "custkey", "left_semi")


@query(_SIDES + "SELECT custkey, c_mktsegment FROM c ANTI JOIN few USING (custkey)")
def join_anti(t):
    return _accepted(t).join(_orders(t).filter("o_totalprice > 300000"), "custkey", "left_anti")


@query("""
    SELECT c_nationkey AS nation, c_mktsegment AS segment, customers, rich
    FROM (SELECT c_nationkey, c_mktsegment, count(*) AS customers FROM customer GROUP BY 1, 2)
    JOIN (SELECT c_nationkey, c_mktsegment, count(*) AS rich FROM customer WHERE c_acctbal > 8000 GROUP BY 1, 2)
    USING (c_nationkey, c_mktsegment)
""")
def join_using(t):
    customer = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
                                 "c_acctbal")
    everyone = customer.groupBy("nation", "segment").agg(F.count(F.lit(1)).alias("customers"))
    rich = customer.filter("c_acctbal > 8000").groupBy("nation", "segment").agg(F.count(F.lit(1)).alias("rich"))
    return everyone.join(rich, ["nation", "segment"])


@query("""
    SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name FROM orders o JOIN customer c
    ON o.o_custkey = c.c_custkey AND o.o_totalprice > c.c_acctbal * 40
""")
def join_condition(t):
    o, c = t.orders.alias("o"), t.customer.alias("c")
    on = (F.col("o.o_custkey") == F.col("c.c_custkey")) & (F.col("o.o_totalprice") > F.col("c.c_acctbal") * 40)
    return o.join(c, on).select("o.o_orderkey", "o.o_custkey", "c.c_custkey", "c.c_name")


@query("""
    WITH bands AS (SELECT r_regionkey AS band, r_regionkey * 12 AS low, r_regionkey * 12 + 10 AS high FROM region)
    SELECT p_partkey, p_size, band FROM part JOIN bands ON p_size >= low AND p_size < high
""")
def join_theta(t):
    """Part sizes against bands, leaving gaps; meets through cells instead of all pairs."""
    low = F.col("r_regionkey") * 12
    bands = t.region.select(F.col("r_regionkey").alias("band"), low.alias("low"), (low + 10).alias("high"))
    joined = range_join(t.part.select("p_partkey", "p_size"), bands, F.col("p_size"), "low", "high", 5)
    return joined.select("p_partkey", "p_size", "band")


@query("""
    SELECT n_name, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, count(*) AS lines
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
""")
def join_broadcast(t):
    """Nation is broadcast after a look at its size; supplier is left to the planner."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    joined = per.join(t.supplier, per.l_suppkey == F.col("s_suppkey")).join(
        broadcast_small(t.nation, 10_000), F.col("s_nationkey") == F.col("n_nationkey")
    )
    balance = exact_sum(cents("s_acctbal") * F.col("n")).cast("double") / 100
    return joined.groupBy("n_name").agg(balance.alias("balance"), F.sum("n").alias("lines"))


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000")
def join_sortmerge(t):
    orders = t.orders.filter("o_totalprice > 200000")
    return orders.join(t.customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


def _null_keyed(t):
    """Suppliers and nations with key 0 made NULL on both sides."""
    suppliers = t.supplier.select("s_suppkey", F.nullif("s_nationkey", F.lit(0)).alias("nation"))
    nations = t.nation.select(F.nullif("n_nationkey", F.lit(0)).alias("nation"), "n_name")
    return suppliers, nations


_NULL_KEYED = """
    WITH s AS (SELECT s_suppkey, nullif(s_nationkey, 0) AS nation FROM supplier),
         n AS (SELECT nullif(n_nationkey, 0) AS nation, n_name FROM nation)
    SELECT s.nation, s_suppkey, n_name FROM s JOIN n ON s.nation {op} n.nation
"""


@query(_NULL_KEYED.format(op="="))
def join_null_keys(t):
    suppliers, nations = _null_keyed(t)
    return suppliers.join(nations, "nation")


@query(_NULL_KEYED.format(op="IS NOT DISTINCT FROM"))
def join_null_safe(t):
    return null_safe_join(*_null_keyed(t), ["nation"])


@query("""
    SELECT r_name, n_name, c_mktsegment, l_returnflag, count(*) AS lines,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3, 4
""")
def join_five_way(t):
    return t.sql(
        """
        SELECT r_name, n_name, c_mktsegment, l_returnflag, count(*) AS lines,
               CAST(SUM(CAST(rint(l_extendedprice * 100) AS DECIMAL(18,0))) AS DOUBLE) / 100 AS price
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name, c_mktsegment, l_returnflag
        """,
        "lineitem orders customer nation region",
    )


@query("""
    WITH staff AS (SELECT s_suppkey, s_name, s_nationkey,
                          nullif(min(s_suppkey) OVER (PARTITION BY s_nationkey), s_suppkey) AS lead_key FROM supplier)
    SELECT s.s_suppkey, s.s_name, l.s_suppkey AS lead_key, l.s_name AS lead_name
    FROM staff s JOIN staff l ON s.lead_key = l.s_suppkey
""")
def self_join(t):
    """Each supplier with the first supplier of its nation, who has no lead."""
    first = t.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("lead_key"))
    staff = t.supplier.join(first, "s_nationkey").select(
        "s_suppkey", "s_name", F.nullif("lead_key", F.col("s_suppkey")).alias("lead_key")
    )
    s, lead = staff.alias("s"), staff.alias("l")
    return s.join(lead, F.col("s.lead_key") == F.col("l.s_suppkey")).select(
        "s.s_suppkey", "s.s_name", F.col("l.s_suppkey").alias("lead_key"), F.col("l.s_name").alias("lead_name")
    )


def _versions(t):
    """Order-status history per customer: each order opens a version lasting to the next order date.

    A customer has one row a day, so a key's rows are bounded by the calendar and a plain window holds.
    """
    per_day = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("effective_start")).agg(
        F.max("o_orderpriority").alias("priority")
    )
    following = F.lead("effective_start").over(Window.partitionBy("o_custkey").orderBy("effective_start"))
    return per_day.select(
        F.col("o_custkey").alias("cust"), "priority", "effective_start", following.alias("effective_end")
    )


def _facts(t):
    """Events as facts of customers, a year of days after the first order date and on."""
    day = F.date_add(F.lit("1996-01-01").cast("date"), F.pmod("event_id", F.lit(2500)).cast("int"))
    return t.events.select("event_id", F.col("user_id").alias("cust"), day.alias("day"))


_PIT = """
    WITH per AS (SELECT o_custkey AS cust, CAST(o_orderdate AS DATE) AS s, max(o_orderpriority) AS priority
                 FROM orders GROUP BY 1, 2),
         v AS (SELECT cust, priority, s, lead(s) OVER (PARTITION BY cust ORDER BY s) AS e FROM per),
         f AS (SELECT event_id, user_id AS cust, DATE '1996-01-01' + CAST(event_id % 2500 AS INTEGER) AS day
               FROM events)
    SELECT f.event_id, f.cust, CAST(f.day AS DATE) AS day, v.priority FROM f {how} JOIN v
    ON f.cust = v.cust AND f.day >= v.s AND (v.e IS NULL OR f.day < v.e)
"""


@query(_PIT.format(how="LEFT"), name="pit_join")
def pit_join_query(t):
    return pit_join(_facts(t), _versions(t), ["cust"], "day").select("event_id", "cust", "day", "priority")


@query(_PIT.format(how=""))
def pit_join_inner(t):
    joined = pit_join(_facts(t), _versions(t), ["cust"], "day", how="inner")
    return joined.select("event_id", "cust", "day", "priority")


@query(_PIT.format(how="LEFT"))
def pit_join_many_versions(t):
    # Read for the sample, the carry and the line: stored once.
    versions = cut_lineage(_versions(t))
    return asof_versions(_facts(t), versions, ["cust"], "day", ["priority"], split=Split(1_000, 16))


def _skewed_events(t):
    """Events where nine tenths of the rows carry the key -1."""
    key = F.when(F.col("user_id") % 10 != 0, F.lit(-1).cast("bigint")).otherwise(F.col("user_id"))
    return t.events.select("event_id", key.alias("key"), "value")


_SKEWED = """
    WITH e AS (SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN -1 ELSE user_id END AS key, value FROM events),
         d AS (SELECT c_custkey - 1 AS key, c_mktsegment AS label FROM customer)
"""


def _labels(t):
    return t.customer.select((F.col("c_custkey") - 1).alias("key"), F.col("c_mktsegment").alias("label"))


@query(_SKEWED + "SELECT e.key, event_id, value, label FROM e JOIN d ON e.key = d.key", name="salted_join")
def salted_join_query(t):
    """The key of nine tenths of the rows gets as many salts as it needs, all others none."""
    return salted_join(_skewed_events(t), _labels(t), ["key"], ["event_id"], rows=10_000)


@query(_SKEWED + "SELECT e.key, event_id, value, label FROM e LEFT JOIN d ON e.key = d.key")
def salted_join_hot(t):
    events = _skewed_events(t)
    return salted_join(events, _labels(t), ["key"], ["event_id"], rows=10_000, how="left")


@query("""
    WITH e AS (SELECT CASE WHEN user_id % 10 <> 0 THEN -1 ELSE user_id END AS key FROM events),
         n AS (SELECT key, count(*) AS row_count FROM e GROUP BY 1)
    SELECT key, row_count, CAST(ceil(row_count / 500) AS INTEGER) AS salts, TRUE AS balanced
    FROM n WHERE row_count > 500
""")
def salted_balance(t):
    """Rows of each large key, its salts, and whether its largest sub-key is within half as much again of the aim."""
    left, _ = salted_parts(_skewed_events(t), _labels(t), ["key"], ["event_id"], rows=500)
    parts = left.groupBy("key", SALT).agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("key").agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).cast("int").alias("salts"), F.max("n").alias("largest")
    )
    return whole.filter("row_count > 500").select("key", "row_count", "salts", (F.col("largest") <= 750).alias("balanced"))


@query("""
    SELECT n_name AS nation, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def join_preaggregated(t):
    """Orders shrink to one row per customer before they meet the customers."""
    per = t.orders.groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("paid"))
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        per.join(nations.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("n_name").alias("nation"))
        .agg((exact_sum(F.col("paid")).cast("double") / 100).alias("revenue"))
    )


