"""Projection, filters, predicates and SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import money, money_avg, safe_cast
from tidemark.operators.predicates import allowed_name, cast_failures, filter_all, not_in, run_sql
from tidemark.queries._registry import query


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def project_basic(t):
    orders = t.orders
    return orders.select("o_orderkey", F.col("o_custkey"), orders["o_totalprice"])


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS taxed
    FROM lineitem
""")
def derive_chain(t):
    return (
        t.lineitem.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("taxed", F.col("net") * (1 + F.col("l_tax")))
        .select("l_orderkey", "l_linenumber", "net", "taxed")
    )


@query("SELECT c_custkey, upper(c_mktsegment) AS c_mktsegment FROM customer")
def replace_column(t):
    return t.customer.withColumn("c_mktsegment", F.upper("c_mktsegment")).select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, TRUE AS is_active, 'batch' AS origin FROM customer")
def literal_flag(t):
    return t.customer.select("c_custkey", F.lit(True).alias("is_active"), F.lit("batch").alias("origin"))


@query("SELECT c_custkey, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer")
def drop_rename(t):
    return t.customer.drop("c_name").withColumnRenamed("c_acctbal", "balance")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem
    WHERE l_quantity > 45 AND (l_returnflag = 'R' OR NOT (l_linestatus = 'O'))
""")
def filter_compound(t):
    return t.lineitem.filter(
        (F.col("l_quantity") > 45) & ((F.col("l_returnflag") == "R") | ~(F.col("l_linestatus") == "O"))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")


def _sized_parts(t):
    """Parts whose size 1 stands for "not measured"."""
    return t.part.withColumn("size", F.nullif("p_size", F.lit(1)))


@query("""
    SELECT p_partkey, nullif(p_size, 1) IS NULL AS is_missing,
           nullif(p_size, 1) IS NOT NULL AS is_present
    FROM part WHERE nullif(p_size, 1) IS NULL OR nullif(p_size, 1) > 45
""")
def null_test(t):
    size = F.col("size")
    return (
        _sized_parts(t)
        .filter(size.isNull() | (size > 45))
        .select("p_partkey", size.isNull().alias("is_missing"), size.isNotNull().alias("is_present"))
    )


@query("""
    SELECT count(*) FILTER (WHERE nullif(p_size, 1) = NULL) AS equal_null,
           count(*) FILTER (WHERE nullif(p_size, 1) <> 2) AS not_two,
           count(*) AS all_rows
    FROM part
""")
def null_comparison(t):
    size = F.col("size")
    return _sized_parts(t).agg(
        F.count_if(size == F.lit(None)).alias("equal_null"),
        F.count_if(size != 2).alias("not_two"),
        F.count(F.lit(1)).alias("all_rows"),
    )


@query("SELECT p_partkey, coalesce(nullif(p_size, 1), 0) AS size FROM part")
def coalesce_fill(t):
    return _sized_parts(t).select("p_partkey", F.coalesce("size", F.lit(0)).alias("size"))


@query("""
    SELECT 'filled' AS how, p_partkey, coalesce(nullif(p_size, 1), -1) AS size,
           coalesce(nullif(p_type, 'PROMO'), 'none') AS kind FROM part
    UNION ALL
    SELECT 'dropped', p_partkey, p_size, p_type FROM part WHERE p_size <> 1 AND p_type <> 'PROMO'
""")
def na_fill_drop(t):
    parts = _sized_parts(t).select("p_partkey", "size", F.nullif("p_type", F.lit("PROMO")).alias("kind"))
    filled = parts.na.fill({"size": -1, "kind": "none"}).withColumn("how", F.lit("filled"))
    return filled.unionByName(parts.na.drop(subset=["size", "kind"]).withColumn("how", F.lit("dropped")))


@query("""
    SELECT c_custkey, CASE WHEN nullif(c_nationkey, 0) IS NULL THEN 'unknown'
                           WHEN c_acctbal >= 7500 THEN 'high' WHEN c_acctbal >= 2500 THEN 'mid'
                           ELSE 'low' END AS band
    FROM customer
""")
def band_case(t):
    return t.customer.select(
        "c_custkey",
        F.when(F.nullif("c_nationkey", F.lit(0)).isNull(), "unknown")
        .when(F.col("c_acctbal") >= 7500, "high")
        .when(F.col("c_acctbal") >= 2500, "mid")
        .otherwise("low")
        .alias("band"),
    )


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def in_list(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice * 0.1 AS fee,
           CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state
    FROM orders
""")
def select_expr(t):
    return t.orders.selectExpr(
        "o_orderkey",
        "year(o_orderdate) AS order_year",
        "o_totalprice * 0.1D AS fee",
        "CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state",
    )


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side FROM customer")
def expr_case(t):
    return t.customer.withColumn("side", F.expr("CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END")).select(
        "c_custkey", "side"
    )


@query("""
    SELECT c_custkey, c_acctbal FROM customer
    WHERE c_acctbal BETWEEN 100 AND 900 AND c_mktsegment LIKE 'M%'
""")
def filter_sql(t):
    return t.customer.filter("c_acctbal BETWEEN 100 AND 900 AND c_mktsegment LIKE 'M%'").select(
        "c_custkey", "c_acctbal"
    )


def _texts(t):
    """Event property ``k`` as text; every value divisible by 7 is made unreadable."""
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        "event_id", F.when(F.pmod("event_id", F.lit(7)) == 0, F.concat(F.lit("n"), k)).otherwise(k).alias("k_text")
    )


_TEXTS = """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'n' || json_extract_string(props, '$.k')
                          ELSE json_extract_string(props, '$.k') END AS k_text
    FROM events
"""


@query(f"SELECT event_id, TRY_CAST(k_text AS INTEGER) AS k FROM ({_TEXTS})", name="safe_cast")
def safe_cast_query(t):
    return _texts(t).select("event_id", safe_cast("k_text", "int").alias("k"))


@query(
    f"SELECT event_id, k_text FROM ({_TEXTS}) WHERE k_text IS NOT NULL AND TRY_CAST(k_text AS INTEGER) IS NULL",
    name="cast_failures",
)
def cast_failures_query(t):
    return cast_failures(_texts(t), "k_text", "int")


@query("SELECT p_partkey, nullif(p_type, 'PROMO') AS kind FROM part")
def nullif_sentinel(t):
    return t.part.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("kind"))


@query("""
    SELECT 'strict' AS how, p_partkey FROM part WHERE NOT (nullif(p_size, 1) > 25)
    UNION ALL
    SELECT 'or_null', p_partkey FROM part WHERE NOT (nullif(p_size, 1) > 25) OR nullif(p_size, 1) IS NULL
""")
def not_three_valued(t):
    size = F.col("size")
    parts = _sized_parts(t)
    strict = parts.filter(~(size > 25)).select(F.lit("strict").alias("how"), "p_partkey")
    return strict.union(parts.filter(~(size > 25) | size.isNull()).select(F.lit("or_null"), "p_partkey"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000")
def param_sql(t):
    return run_sql(
        t.spark,
        "SELECT c_custkey, c_acctbal FROM {customer} WHERE c_mktsegment = :segment AND c_acctbal > :floor",
        {"segment": "BUILDING", "floor": 1000.0},
        customer=t.customer,
    )


@query("SELECT count(*) AS matches FROM customer WHERE c_mktsegment = ''' OR ''1''=''1'")
def param_injection(t):
    return run_sql(
        t.spark,
        "SELECT count(*) AS matches FROM {customer} WHERE c_mktsegment = :segment",
        {"segment": "' OR '1'='1"},
        customer=t.customer,
    )


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F' AND o_custkey < 1000")
def dynamic_filter(t):
    wanted = {"o_orderstatus": "F"}
    orders = t.orders
    predicates = [F.col(allowed_name(k, orders.columns)) == v for k, v in wanted.items()]
    predicates += [F.col("o_totalprice") > 100000, F.col("o_custkey") < 1000]
    return filter_all(orders, predicates).select("o_orderkey")


@query("""
    WITH mean AS (SELECT c_mktsegment, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_bal
                  FROM customer GROUP BY 1)
    SELECT c_custkey, c.c_mktsegment, c_acctbal, avg_bal FROM customer c JOIN mean USING (c_mktsegment)
    WHERE c_acctbal > avg_bal
""")
def cte_above_avg(t):
    mean = t.customer.groupBy("c_mktsegment").agg(money_avg("c_acctbal").alias("avg_bal"))
    return run_sql(
        t.spark,
        """
        WITH mean AS (SELECT * FROM {mean})
        SELECT c_custkey, c.c_mktsegment, c_acctbal, avg_bal
        FROM {customer} c JOIN mean ON c.c_mktsegment = mean.c_mktsegment
        WHERE c_acctbal > avg_bal
        """,
        mean=mean,
        customer=t.customer,
    )


@query("""
    SELECT c_custkey FROM customer c
    WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def exists_semi(t):
    return t.sql(
        """
        SELECT c_custkey FROM {customer} c
        WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
        """,
        "customer orders",
    )


@query("""
    SELECT c_custkey FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def not_exists(t):
    return t.sql(
        """
        SELECT c_custkey FROM {customer} c
        WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
        """,
        "customer orders",
    )


@query("""
    SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT nullif(c_nationkey, 0) FROM customer)
""")
def not_in_null(t):
    listed = t.customer.select(F.nullif("c_nationkey", F.lit(0)).alias("n"))
    return not_in(t.supplier, "s_nationkey", listed, "n").select("s_suppkey")


@query("""
    SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN
      (SELECT nullif(c_nationkey, 0) FROM customer WHERE c_nationkey BETWEEN 1 AND 12)
""")
def not_in_rows(t):
    """The twin of ``not_in_null`` with rows: this list holds no NULL."""
    some = t.customer.filter("c_nationkey BETWEEN 1 AND 12").select(F.nullif("c_nationkey", F.lit(0)).alias("n"))
    return not_in(t.supplier, "s_nationkey", some, "n").select("s_suppkey")


@query("""
    SELECT o_orderkey, nullif(o_custkey, 1) AS cust FROM orders
    WHERE nullif(o_custkey, 1) NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)
""")
def not_in_list(t):
    orders = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(1)).alias("cust"))
    return not_in(orders, "cust", t.customer.filter("c_acctbal < 5000"), "c_custkey")


@query("""
    SELECT c_mktsegment, count(*) AS customers,
           CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer WHERE c_acctbal > 0 GROUP BY 1
""")
def sql_df_twin(t):
    """The same question in SQL text; the test compares its plan with the DataFrame form."""
    return t.sql(
        """
        SELECT c_mktsegment, count(1) AS customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM {customer} WHERE c_acctbal > 0 GROUP BY c_mktsegment
        """,
        "customer",
    )


def sql_df_twin_frame(t):
    return (
        t.customer.filter(F.col("c_acctbal") > 0)
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
    )
