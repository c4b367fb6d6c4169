"""Readers and writers over whole tables; copies go to the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import money_sum
from tidemark.operators.quality import Rule
from tidemark.plans import daily_load
from tidemark.queries._registry import query
from tidemark.session import scratch_path
from tidemark.sources import catalog
from tidemark.sources.files import (
    read_csv,
    read_csv_inferred,
    read_evolving,
    read_json_document,
    read_json_lines,
    read_orc,
    read_parquet,
    read_with_quarantine,
    reliable_count,
)
from tidemark.sources.sinks import compact, replace_slice, write


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 49")
def scan_prune(t):
    return read_parquet(t.spark, t.path("lineitem")).filter("l_quantity >= 49").select("l_orderkey", "l_quantity")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def orc_roundtrip(t):
    path = scratch_path(t.spark, "orc")
    write(t.customer, path, fmt="orc")
    return read_orc(t.spark, path).filter("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal")


@query("""
    SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS balance FROM customer WHERE c_acctbal < 5000
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 5000
""")
def schema_evolve(t):
    """Customers below 5000 written without the balance column, the others with it."""
    path = scratch_path(t.spark, "evolve")
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("balance"))
    write(base.filter("balance < 5000").drop("balance"), f"{path}/v1")
    write(base.filter("balance >= 5000"), f"{path}/v2")
    return read_evolving(t.spark, f"{path}/v1", f"{path}/v2")


@query("""
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 1000
""")
def partition_prune(t):
    path = scratch_path(t.spark, "parted")
    write(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, partition_by=["o_orderstatus"])
    return read_parquet(t.spark, path).filter("o_orderstatus = 'P' AND o_totalprice > 1000")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders,
           CAST(SUM(CAST(CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE o_totalprice END AS DECIMAL(18,2))) AS DOUBLE)
             AS total
    FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY 1
""", name="replace_slice")
def replace_slice_query(t):
    """Load all years, then replace 1996 (twice, as a retry would) and empty 1997."""
    path = scratch_path(t.spark, "slices")
    orders = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    write(orders, path, partition_by=["order_year"])
    fixed = orders.filter("order_year = 1996").withColumn("o_totalprice", F.lit(1.0))
    for _ in range(2):
        replace_slice(fixed, path, "order_year", [1996, 1997])
    return (
        read_parquet(t.spark, path)
        .groupBy("order_year")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("total"))
    )


@query("""
    SELECT strftime(month, '%Y-%m-%d') AS month, count(*) AS orders,
           CASE WHEN year(month) = 1996 THEN 1.0 * count(*) ELSE round(sum(o_totalprice), 2) END AS total
    FROM (SELECT o_totalprice, date_trunc('month', CAST(o_orderdate AS DATE)) AS month FROM orders)
    WHERE month <> DATE '1997-01-01'
    GROUP BY month
""")
def replace_slice_dates(t):
    """All orders in monthly slices: those of 1996 replaced (named as text, then as dates), January 1997 emptied."""
    path = scratch_path(t.spark, "months")
    month = F.trunc("o_orderdate", "month").alias("month")
    orders = t.orders.select("o_orderkey", "o_totalprice", month)
    write(orders, path, partition_by=["month"])
    fixed = orders.filter("year(month) = 1996").withColumn("o_totalprice", F.lit(1.0))
    months = [dt.date(1996, m, 1) for m in range(1, 13)] + [dt.date(1997, 1, 1)]
    replace_slice(fixed, path, "month", [str(m) for m in months])
    replace_slice(fixed, path, "month", months)
    return (
        read_parquet(t.spark, path)
        .groupBy(F.col("month").cast("string").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("total"))
    )


@query("""
    SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_roundtrip(t):
    path = scratch_path(t.spark, "json")
    rows = t.events.select("event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    write(rows, path, fmt="json")
    return read_json_lines(t.spark, path, rows.schema)


_EVENT = "event_id bigint, value double"
_SIDES = """
    SELECT 'clean' AS side, count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS ids FROM events
    WHERE event_id % 10 <> 0
    UNION ALL
    SELECT 'quarantine', count(*), CAST(sum(CASE WHEN event_id % 20 = 0 THEN event_id END) AS BIGINT) FROM events
    WHERE event_id % 10 = 0
"""


def _dirty_json(t) -> str:
    """Events as JSON text, every tenth damaged: broken syntax and wrong types in turn."""
    path = scratch_path(t.spark, "json")
    good = F.to_json(F.struct("event_id", "value"))
    wrong_type = F.to_json(F.struct("event_id", F.lit("bad").alias("value")))
    broken = F.concat(F.lit('{"event_id" '), F.col("event_id").cast("string"))
    line = F.when(F.col("event_id") % 20 == 0, wrong_type).when(F.col("event_id") % 10 == 0, broken).otherwise(good)
    t.events.select(line.alias("value")).write.text(path)
    return path


def _count_sides(clean, bad):
    count = [F.count(F.lit(1)).alias("row_count"), F.sum("event_id").alias("ids")]
    named = [f.agg(*count).withColumn("side", F.lit(n)) for n, f in (("clean", clean), ("quarantine", bad))]
    return named[0].unionByName(named[1])


@query(_SIDES)
def json_quarantine(t):
    return _count_sides(*read_with_quarantine(t.spark, _dirty_json(t), StructType.fromDDL(_EVENT), "json"))


@query(_SIDES)
def csv_quarantine(t):
    """The same events as CSV lines: a value that is no number, and a line without its key, in turn."""
    path = scratch_path(t.spark, "csv")
    key, value = F.col("event_id").cast("string"), F.col("value").cast("string")
    line = (
        F.when(F.col("event_id") % 20 == 0, F.concat_ws(",", key, F.lit("bad")))
        .when(F.col("event_id") % 10 == 0, F.concat_ws(",", F.lit("n/a"), value))
        .otherwise(F.concat_ws(",", key, value))
    )
    t.events.select(line.alias("value")).write.text(path)
    return _count_sides(*read_with_quarantine(t.spark, path, StructType.fromDDL(_EVENT), "csv", header=False))


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders
""")
def csv_roundtrip(t):
    path = scratch_path(t.spark, "csv")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    rows.write.csv(path, header=True)
    return read_csv(t.spark, path, rows.schema)


@query("""
    SELECT CASE WHEN event_id % 10 = 0 AND event_id % 20 <> 0 THEN 'unparseable'
                WHEN event_id % 20 = 0 THEN 'unparseable'
                WHEN value <= 50 THEN 'value_too_small' ELSE 'good' END AS outcome,
           count(*) AS row_count,
           CAST(SUM(CASE WHEN event_id % 10 <> 0 THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS total
    FROM events GROUP BY 1
""", name="daily_load")
def daily_load_query(t):
    """Two days with the same input, the first one loaded again as a retry would."""
    raw, out = _dirty_json(t), scratch_path(t.spark, "daily")
    rules = [Rule("value_too_small", F.col("value") > 50)]
    schema = StructType.fromDDL(_EVENT)
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        silver, dead = daily_load.run(t.spark, raw, schema, rules, day, out)
    first = F.col("load_date") == "2024-01-01"
    rows = silver.filter(first).select(F.lit("good").alias("outcome"), "value").unionByName(
        dead.filter(first).select(F.array_join("reasons", ",").alias("outcome"), "value")
    )
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"), money_sum("value").alias("total"))


@query("SELECT event_id, user_id, value FROM events")
def compact_files(t):
    """Many small files rewritten into few; the rows stay the same."""
    src, dst = scratch_path(t.spark, "many"), scratch_path(t.spark, "few")
    write(t.events.select("event_id", "user_id", "value"), src, files=32)
    compact(t.spark, src, dst)
    return read_parquet(t.spark, dst)


@query("""
    SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1
""")
def catalog_tables(t):
    """An external table and a view over it; dropping the table keeps its files."""
    path, name = scratch_path(t.spark, "ext"), f"tm_{uuid.uuid4().hex}"
    write(t.customer.select("c_custkey", "c_mktsegment"), path)
    catalog.register_external(t.spark, name, path)
    listed = catalog.is_managed(t.spark, name)
    catalog.session_view(t.spark.table(name), f"{name}_view")
    rows = t.spark.table(f"{name}_view").filter(F.lit(not listed))
    found = rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    t.spark.catalog.dropTempView(f"{name}_view")
    catalog.drop_table(t.spark, name)
    return found


@query("SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders")
def csv_inferred(t):
    """Numbers, text and days come back typed without a schema."""
    path = scratch_path(t.spark, "csv")
    day = F.to_date("o_orderdate").alias("day")
    t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", day).write.csv(path, header=True)
    rows = read_csv_inferred(t.spark, path)
    return rows.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("""
    SELECT 'PERMISSIVE' AS mode, count(*) AS row_count, count(*) FILTER (WHERE o_orderkey % 10 = 0) AS missing FROM orders
    UNION ALL SELECT 'DROPMALFORMED', count(*) FILTER (WHERE o_orderkey % 10 <> 0), 0 FROM orders
""")
def csv_modes(t):
    """Every tenth price is no number: kept as NULL, or the line is dropped.  Counts parse every column."""
    path = scratch_path(t.spark, "csv")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit("bad")).otherwise(F.col("o_totalprice").cast("string"))
    t.orders.select("o_orderkey", price.alias("o_totalprice")).write.csv(path, header=True)
    schema = StructType.fromDDL("o_orderkey bigint, o_totalprice double")
    found = []
    for mode in ("PERMISSIVE", "DROPMALFORMED"):
        rows = read_csv(t.spark, path, schema, mode)
        found.append((mode, reliable_count(rows), rows.filter("o_totalprice IS NULL").count()))
    return t.spark.createDataFrame(found, "mode string, row_count bigint, missing bigint")


#: Orders in one JSON document at most about this many (by the hash of their key).
DOCUMENT_ROWS = 1_000


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def json_document(t):
    """All orders as indented JSON arrays of about a thousand orders, a file each: a file is one value."""
    path = scratch_path(t.spark, "json")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    # As many documents as the table needs; Parquet counts its rows without reading them.
    documents = max(1, orders.count() // DOCUMENT_ROWS)
    number = F.pmod(F.xxhash64("o_orderkey"), F.lit(documents)).alias("document")
    rows = F.sort_array(F.collect_list(F.struct(*orders.columns)))
    arrays = orders.groupBy(number).agg(F.to_json(rows, {"pretty": "true"}).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_json_document(t.spark, path, orders.schema)


@query("""
    SELECT 'append' AS mode, 2 * count(*) AS row_count FROM customer
    UNION ALL SELECT 'ignore', count(*) FROM customer
    UNION ALL SELECT 'overwrite', count(*) FILTER (WHERE c_acctbal > 0) FROM customer
    UNION ALL SELECT 'errorifexists', count(*) FROM customer
""")
def write_modes(t):
    """Each mode on a table that is there already."""
    found = []
    for mode in ("append", "ignore", "overwrite", "errorifexists"):
        path = scratch_path(t.spark, mode)
        write(t.customer, path)
        rows = t.customer.filter("c_acctbal > 0") if mode in ("overwrite", "ignore") else t.customer
        if mode == "errorifexists":
            try:
                write(rows, path)
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
        else:
            write(rows, path, mode)
        found.append(read_parquet(t.spark, path).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("row_count")))
    return functools.reduce(DataFrame.unionByName, found)


@query("""
    SELECT 'managed' AS kind, column_name AS name, position, count(*) AS row_count
    FROM (VALUES ('c_custkey', 0), ('c_name', 1)) v(column_name, position), customer GROUP BY ALL
""")
def managed_table(t):
    """Save, describe and count a managed table; it is dropped only with its files' loss accepted."""
    name = f"managed_{uuid.uuid4().hex}"
    catalog.save_managed(t.customer.select("c_custkey", "c_name"), name)
    kind = "managed" if catalog.is_managed(t.spark, name) else "external"
    columns = [(kind, c, i) for i, (c, _) in enumerate(catalog.describe_columns(t.spark, name))]
    count = t.spark.table(name).count()
    try:
        catalog.drop_table(t.spark, name)
    except PermissionError:
        catalog.drop_table(t.spark, name, delete_files=True)
    described = t.spark.createDataFrame(columns, "kind string, name string, position int")
    return described.withColumn("row_count", F.lit(count).cast("bigint"))
