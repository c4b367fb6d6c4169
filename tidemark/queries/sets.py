"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.sets import union_all, union_by_name
from tidemark.queries._registry import query


def _customers(t):
    return t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))


def _suppliers(t):
    return t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))


_ROWS = """SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
           {op} SELECT s_nationkey, s_acctbal FROM supplier"""


@query(_ROWS.format(op="UNION ALL"), name="union_all")
def union_all_query(t):
    return union_all(_customers(t), _suppliers(t))


@query(_ROWS.format(op="UNION ALL"), name="union_by_name")
def union_by_name_query(t):
    return union_by_name(_customers(t), _suppliers(t).select("balance", "nation"))


@query("""
    SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier
""")
def union_missing(t):
    customers = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    return union_by_name(customers, _suppliers(t), fill_missing=True)


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return t.sql("SELECT c_nationkey AS nation FROM {customer} UNION SELECT s_nationkey FROM {supplier}",
                 "customer supplier")


@query(_ROWS.format(op="UNION ALL"))
def union_all_sql(t):
    return t.sql("SELECT c_nationkey AS nation, c_acctbal AS balance FROM {customer} "
                 "UNION ALL SELECT s_nationkey, s_acctbal FROM {supplier}", "customer supplier")


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_pairs(t):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("""
    SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
    EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice < 50000
""")
def except_distinct(t):
    orders = t.orders
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return urgent.subtract(orders.filter("o_totalprice < 50000").select("o_custkey"))


@query("""
    SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
    EXCEPT ALL SELECT o_custkey FROM orders WHERE o_totalprice < 50000
""")
def except_all(t):
    """Difference keeping multiplicities, as counts per row: a repeated row is not gathered."""
    orders = t.orders
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return urgent.exceptAll(orders.filter("o_totalprice < 50000").select("o_custkey"))
