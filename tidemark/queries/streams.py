"""Streaming queries: drained over the whole table, then read back from their sink."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions.scalars import money, money_sum
from tidemark.operators.quality import Ref, Rule
from tidemark.plans import order_monitor
from tidemark.queries._registry import query
from tidemark.session import scratch_path
from tidemark.streaming.batches import batch_slice_writer
from tidemark.streaming.runs import cached_batch, progress_log, progress_report, run_available, start
from tidemark.streaming.sources import stream_files, stream_table
from tidemark.streaming.windows import windowed

#: Files in a micro-batch: a first drain of a large table is cut into many batches.
MAX_FILES = 64


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase'")
def stream_append(t):
    out = scratch_path(t.spark, "stream")
    events = stream_table(t.spark, t.path("events"), MAX_FILES).filter("event_type = 'purchase'")
    run_available(events.select("event_id", "event_type", "value"), f"{out}/state", path=f"{out}/rows")
    return t.spark.read.parquet(f"{out}/rows")


@query("""
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2
    HAVING time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'
""")
def stream_tumbling(t):
    """Append mode: a window comes out once the watermark has passed its end."""
    out = scratch_path(t.spark, "stream")
    found = windowed(
        stream_table(t.spark, t.path("events"), MAX_FILES), "ts", "1 hour", "10 minutes",
        {"events": F.count(F.lit(1)), "total": F.sum(money("value"))}, ["event_type"],
    )
    run_available(found, f"{out}/state", path=f"{out}/rows")
    return t.spark.read.parquet(f"{out}/rows").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events",
        F.col("total").cast("double").alias("total"),
    )


@query("""
    SELECT event_type, count(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1
""")
def stream_foreach(t):
    """Each micro-batch is an ordinary DataFrame; it is combined before it is written."""
    out = scratch_path(t.spark, "stream")
    store = batch_slice_writer(f"{out}/rows")

    def handle(batch, batch_id):
        partial = batch.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("events"), F.sum(money("value")).alias("total")
        )
        store(partial, batch_id)

    # One action per batch, so there is nothing to cache.
    run_available(stream_table(t.spark, t.path("events"), MAX_FILES), f"{out}/state", batch=handle)
    partials = t.spark.read.parquet(f"{out}/rows")
    return partials.groupBy("event_type").agg(
        F.sum("events").alias("events"), F.sum("total").cast("double").alias("total")
    )


@query("""
    WITH judged AS (SELECT o_totalprice, NOT (o_totalprice > 5000) OR c_custkey IS NULL AS bad
                    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0)
    SELECT CASE WHEN bad THEN 'dead' ELSE 'silver' END AS side, count(*) AS orders,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM judged GROUP BY 1
""")
def stream_order_monitor(t):
    out = scratch_path(t.spark, "monitor")
    rules = [Rule("amount_too_small", F.col("o_totalprice") > 5000)]
    refs = [Ref("unknown_customer", "o_custkey", t.customer.filter("c_acctbal > 0"), "c_custkey")]
    orders = stream_table(t.spark, t.path("orders"), MAX_FILES).select("o_orderkey", "o_custkey", "o_totalprice")
    seen = order_monitor.monitor(orders, rules, refs, f"{out}/rows", f"{out}/state")
    sides = [
        frame.groupBy(F.lit(side).alias("side")).agg(
            F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("total")
        )
        for side, frame in (("silver", seen.silver), ("dead", seen.dead))
    ]
    return sides[0].unionByName(sides[1])


def _landed(t, out, rows, name, fmt="parquet"):
    """Put rows into the landing folder, as a batch of files of their own; returns the pattern to watch."""
    writer = rows.write.option("header", True) if fmt == "csv" else rows.write
    writer.format(fmt).save(f"{out}/landing/{name}")
    return f"{out}/landing/*"


@query("SELECT event_id, user_id, value FROM events")
def stream_restart(t):
    """Half of the files, a stop, the rest, the same checkpoint: every row once."""
    out = scratch_path(t.spark, "restart")
    events = t.events.select("event_id", "user_id", "value")
    halves = [events.filter(F.col("event_id") % 2 == side) for side in (0, 1)]
    for number, half in enumerate(halves):
        landing = _landed(t, out, half, f"part-{number}")
        # The second run finds no new files, as a scheduled one may.
        for _ in range(2):
            stream = stream_files(t.spark, landing, events.schema, "parquet", 1)
            run_available(stream, f"{out}/state", path=f"{out}/rows")
    return t.spark.read.schema(events.schema).parquet(f"{out}/rows")


@query("""
    WITH e AS (SELECT event_id, ts, time_bucket(INTERVAL '1 hour', ts) AS w FROM events),
         edge AS (SELECT max(ts) - INTERVAL '10 minutes' AS first FROM e
                  WHERE ts < TIMESTAMP '2024-01-15' AND event_id % 10 <> 0),
         kept AS (SELECT w FROM e, edge WHERE ts >= TIMESTAMP '2024-01-15' OR event_id % 10 <> 0
                  OR w + INTERVAL '1 hour' > first)
    SELECT w AS window_start, count(*) AS events FROM kept GROUP BY 1
    HAVING w + INTERVAL '1 hour' <= (SELECT max(ts) FROM e) - INTERVAL '10 minutes'
""")
def stream_late(t):
    """Every tenth event of the first days arrives after the others: what its windows have closed on is left out."""
    out = scratch_path(t.spark, "late")
    early, tenth = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"), F.col("event_id") % 10 == 0
    events = t.events.select("event_id", "ts")
    for number, part in enumerate((early & ~tenth, early & tenth, ~early)):
        landing = _landed(t, out, events.filter(part), f"part-{number}")
        stream = stream_files(t.spark, landing, events.schema, "parquet", MAX_FILES)
        found = windowed(stream, "ts", "1 hour", "10 minutes", {"events": F.count(F.lit(1))})
        run_available(found, f"{out}/state", path=f"{out}/rows")
    rows = t.spark.read.parquet(f"{out}/rows")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "events")


@query("SELECT event_id, event_type, value FROM events WHERE value > 50")
def stream_csv(t):
    """A landing zone of CSV files with header lines."""
    out = scratch_path(t.spark, "csv")
    events = t.events.select("event_id", "event_type", "value")
    stream = stream_files(t.spark, _landed(t, out, events, "part-0", "csv"), events.schema, "csv", 1)
    run_available(stream.filter("value > 50"), f"{out}/state", path=f"{out}/rows")
    return t.spark.read.schema(events.schema).parquet(f"{out}/rows")


@query("""
    SELECT 'complete' AS mode, event_type, count(*) AS events FROM events GROUP BY 2
    UNION ALL SELECT 'update', event_type, count(*) FROM events GROUP BY 2
""")
def stream_output_modes(t):
    """Complete: the last batch holds every group.  Update: the newest row of each group counts."""
    out = scratch_path(t.spark, "modes")
    counts = stream_table(t.spark, t.path("events"), 1).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    for mode in ("complete", "update"):
        run_available(counts, f"{out}/{mode}-state", batch=batch_slice_writer(f"{out}/{mode}"), mode=mode)
    whole, changed = (t.spark.read.parquet(f"{out}/{mode}") for mode in ("complete", "update"))
    last = whole.agg(F.max("batch_id")).scalar()
    newest = changed.groupBy("event_type").agg(F.max_by("events", "batch_id").alias("events"))
    return whole.filter(F.col("batch_id") == last).select(F.lit("complete").alias("mode"), "event_type", "events").unionByName(
        newest.select(F.lit("update").alias("mode"), "event_type", "events")
    )


@query("SELECT count(*) AS rows_seen, 0::BIGINT AS dropped_late FROM events")
def stream_interval(t):
    """Started with an interval trigger, drained, stopped; its progress report adds up to the table."""
    out = scratch_path(t.spark, "interval")
    events = stream_table(t.spark, t.path("events"), MAX_FILES).select("event_id", "value")
    with progress_log(t.spark) as log:
        running = start(events, f"{out}/state", path=f"{out}/rows", every="1 second")
        try:
            running.processAllAvailable()
        finally:
            running.stop()
        report = progress_report(t.spark, running, log)
    return report.agg(
        F.sum("num_input_rows").alias("rows_seen"), F.sum("rows_dropped_late").alias("dropped_late")
    )


@query("""
    SELECT CASE WHEN value > 50 THEN 'good' ELSE 'rejected' END AS side, count(*) AS events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, (SELECT count(*) FROM events) AS rows_read
    FROM events GROUP BY 1
""")
def stream_cached(t):
    """Two sinks fed from one cached micro-batch: the source is read once, so its triggers count each row once."""
    out = scratch_path(t.spark, "cached")
    sinks = {side: batch_slice_writer(f"{out}/{side}") for side in ("good", "rejected")}
    good = F.coalesce(F.col("value") > 50, F.lit(False))

    def handle(batch, batch_id):
        sinks["good"](batch.filter(good), batch_id)
        sinks["rejected"](batch.filter(~good), batch_id)

    events = stream_table(t.spark, t.path("events"), MAX_FILES).select("event_id", "value")
    with progress_log(t.spark) as log:
        drained = run_available(events, f"{out}/state", batch=cached_batch(handle))
        report = progress_report(t.spark, drained, log)
    read = report.agg(F.sum("num_input_rows").alias("rows_read"))
    sides = [
        t.spark.read.schema(events.schema).parquet(f"{out}/{side}").select(F.lit(side).alias("side"), "value") for side in sinks
    ]
    counts = sides[0].unionByName(sides[1]).groupBy("side").agg(
        F.count(F.lit(1)).alias("events"), money_sum("value").alias("total")
    )
    return counts.withColumn("rows_read", read.scalar())


class LostRunError(RuntimeError):
    """Raised by a batch function to end a run as a lost driver would."""


@query("SELECT event_id, user_id, value FROM events")
def stream_crash(t):
    """A run dies after a batch is written and before it is committed; the next one repeats that batch: every row once."""
    out = scratch_path(t.spark, "crash")
    events = t.events.select("event_id", "user_id", "value")
    store, tried, dying = batch_slice_writer(f"{out}/rows"), [], []

    def handle(batch, batch_id):
        store(batch, batch_id)
        tried.append(batch_id)
        if dying:
            raise LostRunError("between the write and the commit")

    # One part is committed, the second dies on its first batch and is run again, the third follows.
    for part in range(3):
        landing = _landed(t, out, events.filter(F.pmod("event_id", F.lit(3)) == part), f"part-{part}")
        stream = stream_files(t.spark, landing, events.schema, "parquet", MAX_FILES)
        if part == 1:
            dying.append(True)
            try:
                run_available(stream, f"{out}/state", batch=handle)
            except StreamingQueryException as error:
                if "LostRunError" not in str(error):
                    raise
            lost = tried[-1]
            dying.clear()
        run_available(stream, f"{out}/state", batch=handle)
    if tried.count(lost) != 2:
        raise AssertionError(f"the lost batch {lost} was not repeated: {tried}")
    return t.spark.read.parquet(f"{out}/rows").select("event_id", "user_id", "value")
