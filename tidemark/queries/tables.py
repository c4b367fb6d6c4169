"""Upserts, versioned tables and type 2 dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.scd import overlaps, scd2_apply, scd2_changes, scd2_on
from tidemark.operators.tables import (
    as_of,
    delete_matched,
    evolve_append,
    expire_history,
    history_log,
    insert_new,
    merge_metrics,
    restore,
    upsert,
)
from tidemark.queries._registry import query


def _accounts(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
                             F.col("c_mktsegment").alias("segment"))


def _changes(t):
    """Low balances raised by 100, and as many new keys beyond the highest."""
    accounts = _accounts(t).filter("balance < 3000")
    top = t.customer.agg(F.max("c_custkey")).scalar()
    changed = accounts.withColumns({"balance": F.col("balance") + 100, "segment": F.lit("MOVED")})
    return changed.unionByName(accounts.withColumn("id", F.col("id") + top + 1))


_ACCOUNTS = """
    WITH a AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer),
         u AS (SELECT id, balance + 100 AS balance, 'MOVED' AS segment FROM a WHERE balance < 3000
               UNION ALL SELECT id + (SELECT max(c_custkey) FROM customer) + 1, balance, segment FROM a
               WHERE balance < 3000)
"""


@query(_ACCOUNTS + """
    SELECT coalesce(u.id, a.id) AS id, CASE WHEN u.id IS NULL THEN a.balance ELSE u.balance END AS balance,
           CASE WHEN u.id IS NULL THEN a.segment ELSE u.segment END AS segment
    FROM a FULL JOIN u ON a.id = u.id
""")
def upsert_all(t):
    return upsert(_accounts(t), _changes(t), ["id"])


@query(_ACCOUNTS + """
    SELECT coalesce(a.id, u.id) AS id,
           CASE WHEN a.id IS NULL THEN u.balance WHEN u.id IS NOT NULL AND a.balance < 5000 THEN u.balance
                ELSE a.balance END AS balance,
           CASE WHEN a.id IS NULL THEN u.segment ELSE a.segment END AS segment
    FROM a FULL JOIN u ON a.id = u.id
""")
def upsert_conditional(t):
    return upsert(_accounts(t), _changes(t), ["id"], set_cols=["balance"], when=F.col("balance") < 5000)


@query(_ACCOUNTS + "SELECT a.* FROM a ANTI JOIN u USING (id)")
def merge_delete(t):
    return delete_matched(_accounts(t), _changes(t), ["id"])


@query(_ACCOUNTS + """
    SELECT CAST(count(*) FILTER (WHERE a.id IS NOT NULL AND u.id IS NOT NULL AND NOT a.balance < 0) AS BIGINT)
             AS rows_updated,
           CAST(count(*) FILTER (WHERE a.id IS NULL) AS BIGINT) AS rows_inserted,
           CAST(count(*) FILTER (WHERE a.id IS NOT NULL AND u.id IS NOT NULL AND a.balance < 0) AS BIGINT)
             AS rows_deleted,
           CAST(count(*) FILTER (WHERE u.id IS NULL) AS BIGINT) AS rows_unchanged
    FROM a FULL JOIN u ON a.id = u.id
""", name="merge_metrics")
def merge_metrics_query(t):
    return merge_metrics(_accounts(t), _changes(t), ["id"], delete=F.col("balance") < 0)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def insert_only(t):
    """Orders up to 1997 are loaded; a batch of all orders then adds only the later ones."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    loaded = t.orders.filter("year(o_orderdate) <= 1997")
    return insert_new(loaded.select(*columns), t.orders.select(*columns), ["o_orderkey"])


@query(name="evolve_append", oracle="""
    SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS country FROM customer
    UNION ALL
    SELECT c_custkey, c_acctbal, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal > 9000
""")
def evolve_append_query(t):
    """An append with a new column: old rows get NULL and matching keys come out twice."""
    batch = (
        t.customer.filter("c_acctbal > 9000")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
                F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("country"))
    )
    return evolve_append(_accounts(t), batch, allow_new=True)


def _history(t):
    """Version 0 loads all customers, 1 raises low balances, 2 deletes customers in debt, 3 raises high balances."""
    accounts = _accounts(t).select("id", "balance")

    def version(rows, number, op, day):
        return rows.select("id", "balance", F.lit(number).alias("version"), F.lit(op).alias("op"),
                           F.lit(day).cast("timestamp_ntz").alias("committed_at"))

    return (
        version(accounts, 0, "upsert", "2024-01-01")
        .unionByName(version(accounts.filter("balance < 3000").withColumn("balance", F.col("balance") + 100), 1, "upsert",
                             "2024-01-02"))
        .unionByName(version(accounts.filter("balance < 0").withColumn("balance", F.lit(None).cast("double")), 2,
                             "delete", "2024-01-03"))
        .unionByName(version(accounts.filter("balance < -500 OR balance > 7000").withColumn("balance", F.col("balance") + 7), 3, "upsert",
                             "2024-01-04"))
    )


_HISTORY = """
    WITH a AS (SELECT c_custkey AS id, c_acctbal AS balance FROM customer),
         h AS (SELECT id, balance, 0 AS version, 'upsert' AS op, TIMESTAMP '2024-01-01' AS committed_at FROM a
               UNION ALL SELECT id, balance + 100, 1, 'upsert', TIMESTAMP '2024-01-02' FROM a WHERE balance < 3000
               UNION ALL SELECT id, NULL, 2, 'delete', TIMESTAMP '2024-01-03' FROM a WHERE balance < 0
               UNION ALL SELECT id, balance + 7, 3, 'upsert', TIMESTAMP '2024-01-04' FROM a
               WHERE balance < -500 OR balance > 7000),
         s AS (SELECT v.n, h.* FROM (SELECT unnest([0, 1, 2, 3]) AS n) v JOIN h ON h.version <= v.n
               QUALIFY row_number() OVER (PARTITION BY v.n, id ORDER BY version DESC) = 1)
"""


@query(_HISTORY + "SELECT id, balance FROM s WHERE n = 2 AND op <> 'delete'")
def as_of_version(t):
    return as_of(_history(t), ["id"], version=2)


@query(_HISTORY + "SELECT id, balance FROM s WHERE n = 1 AND op <> 'delete'")
def as_of_time(t):
    return as_of(_history(t), ["id"], timestamp=dt.datetime(2024, 1, 2, 12))


@query(_HISTORY + """
    SELECT version, max(committed_at) AS committed_at, count(*) FILTER (WHERE op = 'upsert') AS upserts,
           count(*) FILTER (WHERE op = 'delete') AS deletes FROM h GROUP BY 1
""", name="history_log")
def history_log_query(t):
    return history_log(_history(t))


@query(_HISTORY + """
    , old AS (SELECT id, balance FROM s WHERE n = 1 AND op <> 'delete'),
      new AS (SELECT id, balance FROM s WHERE n = 3 AND op <> 'delete')
    SELECT id, balance, version, op, committed_at FROM h
    UNION ALL
    SELECT coalesce(old.id, new.id), CASE WHEN old.id IS NULL THEN new.balance ELSE old.balance END, 4,
           CASE WHEN old.id IS NULL THEN 'delete' ELSE 'upsert' END, TIMESTAMP '2024-01-05'
    FROM old FULL JOIN new ON old.id = new.id
    WHERE old.id IS NULL OR new.id IS NULL OR old.balance IS DISTINCT FROM new.balance
""")
def restore_version(t):
    return restore(_history(t), ["id"], 1, dt.datetime(2024, 1, 5))


@query(_HISTORY + """
    SELECT id, balance, version, op, committed_at FROM s WHERE n = 2 AND op <> 'delete'
    UNION ALL SELECT id, balance, version, op, committed_at FROM h WHERE version > 2
""", name="expire_history")
def expire_history_query(t):
    return expire_history(_history(t), ["id"], 2, now=dt.datetime(2024, 2, 1)).filter("op <> 'expired'")


@query(_HISTORY + """
    , old AS (SELECT id, balance FROM s WHERE n = 2 AND op <> 'delete'),
      new AS (SELECT id, balance FROM s WHERE n = 3 AND op <> 'delete')
    SELECT 'now' AS state, id, balance FROM old
    UNION ALL SELECT 'version 3', id, balance FROM new
""")
def restore_after_expire(t):
    """Expire up to version 2, undo version 3, and read both the restored state and version 3."""
    kept = expire_history(_history(t), ["id"], 2, now=dt.datetime(2024, 2, 1))
    back = restore(kept, ["id"], 2, dt.datetime(2024, 2, 2))
    now = as_of(back, ["id"], version=4).select(F.lit("now").alias("state"), "id", "balance")
    return now.unionByName(as_of(back, ["id"], version=3).select(F.lit("version 3").alias("state"), "id", "balance"))


def _dimension(t):
    """Customers in their first or second version; segment FURNITURE is unknown (NULL)."""
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("tier"), "c_acctbal")
    day = lambda text: F.lit(text).cast("date")
    # Customers in debt had an earlier version, closed on 2024-03-01.
    closed = base.filter("c_acctbal < 0").select(
        "id", "name", F.lit("OLD").alias("tier"), day("2024-01-01").alias("effective_start"),
        day("2024-03-01").alias("effective_end"), F.lit(False).alias("is_current"),
    )
    opened = base.select(
        "id", "name", "tier",
        F.when(F.col("c_acctbal") < 0, day("2024-03-01")).otherwise(day("2024-01-01")).alias("effective_start"),
        F.lit(None).cast("date").alias("effective_end"), F.lit(True).alias("is_current"),
    )
    return closed.unionByName(opened)


def _incoming(t):
    """Customers in debt or with much credit arrive; those in segment MACHINERY become unknown; new keys come too."""
    top = t.customer.agg(F.max("c_custkey")).scalar()
    some = t.customer.filter("c_acctbal < 0 OR c_acctbal > 6000")
    segment = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    known = some.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), segment.alias("tier"))
    return known.unionByName(known.withColumn("id", F.col("id") + top + 1))


_DIM = """
    WITH base AS (SELECT c_custkey AS id, c_name AS name, nullif(c_mktsegment, 'FURNITURE') AS tier, c_acctbal
                  FROM customer),
         dim AS (SELECT id, name, 'OLD' AS tier, DATE '2024-01-01' AS s, DATE '2024-03-01' AS e, FALSE AS cur
                 FROM base WHERE c_acctbal < 0
                 UNION ALL
                 SELECT id, name, tier, CASE WHEN c_acctbal < 0 THEN DATE '2024-03-01' ELSE DATE '2024-01-01' END,
                        NULL, TRUE FROM base),
         known AS (SELECT c_custkey AS id, c_name AS name, nullif(c_mktsegment, 'MACHINERY') AS tier FROM customer
                   WHERE c_acctbal < 0 OR c_acctbal > 6000),
         inc AS (SELECT * FROM known UNION ALL
                 SELECT id + (SELECT max(c_custkey) FROM customer) + 1, name, tier FROM known),
         chg AS (SELECT inc.* FROM inc JOIN dim ON inc.id = dim.id AND dim.cur
                 WHERE inc.tier IS DISTINCT FROM dim.tier),
         nxt AS (SELECT dim.id, dim.name, dim.tier, s AS effective_start,
                        CASE WHEN cur AND chg.id IS NOT NULL THEN DATE '2024-06-01' ELSE e END AS effective_end,
                        cur AND chg.id IS NULL AS is_current
                 FROM dim LEFT JOIN chg ON dim.id = chg.id
                 UNION ALL SELECT id, name, tier, DATE '2024-06-01', NULL, TRUE FROM chg
                 UNION ALL SELECT id, name, tier, DATE '2024-06-01', NULL, TRUE FROM inc
                 WHERE id NOT IN (SELECT id FROM dim))
"""


@query(_DIM + "SELECT id, name, tier FROM chg", name="scd2_changes")
def scd2_changes_query(t):
    return scd2_changes(_dimension(t), _incoming(t), ["id"], ["tier"])


@query(_DIM + "SELECT * FROM nxt", name="scd2_apply")
def scd2_apply_query(t):
    return scd2_apply(_dimension(t), _incoming(t), ["id"], ["tier"], dt.date(2024, 6, 1))


@query(_DIM + """
    SELECT id, name, tier, effective_start, effective_end, is_current FROM nxt
    WHERE effective_start <= DATE '2024-02-15' AND (effective_end IS NULL OR DATE '2024-02-15' < effective_end)
""")
def scd2_as_of(t):
    nxt = scd2_apply(_dimension(t), _incoming(t), ["id"], ["tier"], dt.date(2024, 6, 1))
    return scd2_on(nxt, dt.date(2024, 2, 15))


@query(_DIM + """
    SELECT id, name, tier, s AS effective_start, e AS effective_end, cur AS is_current FROM (
      SELECT id, name, tier, CASE WHEN id % 2 = 0 AND cur AND s = DATE '2024-03-01' THEN DATE '2024-02-01' ELSE s END
             AS s, e, cur FROM dim)
    QUALIFY s < lag(coalesce(e, DATE '9999-12-31')) OVER (PARTITION BY id ORDER BY s, e NULLS LAST)
""")
def scd2_overlaps(t):
    """Every second reopened version is moved into its predecessor's interval."""
    late = F.lit("2024-03-01").cast("date")
    moved = (F.col("id") % 2 == 0) & F.col("is_current") & (F.col("effective_start") == late)
    start = F.when(moved, F.lit("2024-02-01").cast("date")).otherwise(F.col("effective_start"))
    return overlaps(_dimension(t).withColumn("effective_start", start), ["id"])
