"""Structured Streaming: modes, triggers, late data, restarts, micro-batches."""

import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import functions as F

from tests.fixtures import ORDERS, orders, rows, staff, write_csv, write_lines
from tidemark import schemas
from tidemark.plans import order_monitor
from tidemark.streaming.batches import batch_slice_writer
from tidemark.streaming.runs import NotFinishedError, cached_batch, progress_log, progress_report, run_available, start
from tidemark.streaming.sources import stream_files, stream_table
from tidemark.streaming.windows import windowed


@pytest.fixture
def landing(tmp_path):
    """Three files of five orders."""
    for i in range(3):
        write_csv(tmp_path / "in" / f"part{i}.csv", ORDERS[5 * i : 5 * i + 5])
    return str(tmp_path / "in")


def orders_stream(spark, landing, max_files=None):
    return stream_files(spark, landing, schemas.landing_orders(), "csv", max_files)


def test_append_picks_up_later_files(spark, landing, tmp_path):
    stream = orders_stream(spark, landing)
    assert stream.isStreaming
    query = start(stream, str(tmp_path / "cp"), memory="picked")
    try:
        query.processAllAvailable()
        assert spark.table("picked").count() == 15
        write_csv(tmp_path / "in" / "more.csv", [(2000, 4, "Widget A", "Hardware", 1.0, "2023-08-01", "West")])
        query.processAllAvailable()
        assert spark.table("picked").count() == 16
    finally:
        query.stop()


def test_header_and_schema(spark, landing):
    assert rows(spark.read.csv(landing, header=True, schema=schemas.landing_orders())) == rows(orders(spark))
    with pytest.raises(IllegalArgumentException, match="Schema must be specified"):
        spark.readStream.option("header", True).csv(landing)


def test_batch_actions_are_rejected(spark, landing):
    with pytest.raises(AnalysisException, match="writeStream"):
        orders_stream(spark, landing).count()


def test_output_modes(spark, landing, tmp_path):
    totals = orders_stream(spark, landing, 1).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    run_available(totals, str(tmp_path / "c1"), memory="complete_out", mode="complete")
    assert rows(spark.table("complete_out")) == [("East", 4), ("North", 3), ("South", 1), ("West", 7)]
    seen = []
    run_available(totals, str(tmp_path / "c2"), batch=lambda df, i: seen.append(rows(df)), mode="update")
    # Update mode emits only the regions touched by the batch.
    assert len(seen) == 3 and [r for b in seen for r in b if r[0] == "South"] == [("South", 1)]
    with pytest.raises(AnalysisException, match="[Aa]ppend"):
        run_available(totals, str(tmp_path / "c3"), memory="append_out")


def test_available_now_stops_itself(spark, landing, tmp_path):
    query = run_available(orders_stream(spark, landing, 1), str(tmp_path / "cp"), path=str(tmp_path / "out"))
    assert not query.isActive
    assert [p["numInputRows"] for p in query.recentProgress] == [5, 5, 5]
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(orders(spark))


def test_interval_trigger_fires_at_once(spark, landing, tmp_path):
    query = start(orders_stream(spark, landing), str(tmp_path / "cp"), memory="timed", every="1 hour")
    try:
        deadline = time.time() + 60
        while spark.table("timed").count() < 15 and time.time() < deadline:
            time.sleep(0.2)
        assert spark.table("timed").count() == 15
    finally:
        query.stop()


def test_exactly_one_sink(spark, landing, tmp_path):
    with pytest.raises(ValueError, match="one sink"):
        start(orders_stream(spark, landing), str(tmp_path / "cp"))
    with pytest.raises(ValueError, match="one sink"):
        start(orders_stream(spark, landing), str(tmp_path / "cp"), memory="a", console=True)


def event(i, second):
    return f"{i},c{i},2024-01-01T00:00:{second:02d}Z"


def test_late_rows(spark, tmp_path):
    """Tolerance 5 s, windows of 10 s, one row per batch at seconds 0, 12, 3, 25, 4."""
    folder = tmp_path / "in"
    schema = spark.createDataFrame([], "order_id int, customer string, event_time timestamp").schema
    folder.mkdir()
    stream = stream_files(spark, str(folder), schema, max_files=1)
    found = windowed(stream, "event_time", "10 seconds", "5 seconds",
                     {"n": F.count(F.lit(1)), "total": F.sum("order_id")})
    query = start(found, str(tmp_path / "cp"), memory="late_update", mode="update")
    try:
        for i, (order_id, second) in enumerate([(1, 0), (2, 12), (100, 3), (4, 25), (500, 4)]):
            write_lines(folder / f"f{i}.csv", ["order_id,customer,event_time", event(order_id, second)])
            query.processAllAvailable()
        final = {}
        for r in spark.table("late_update").collect():
            final[r["window_start"].second] = (r["n"], r["total"])
        # 3 s came late but in time and joined the first window; 4 s came after it had closed.
        assert final == {0: (2, 101), 10: (1, 2), 20: (1, 4)}
        report = progress_report(spark, query)
        assert report.agg(F.sum("rows_dropped_late")).first()[0] == 1
        assert report.agg(F.sum("num_input_rows")).first()[0] == 5
    finally:
        query.stop()


RESTART = """
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark.sql import functions as F
    from tidemark import schemas
    from tidemark.session import build_session
    from tidemark.plans import order_monitor
    spark = build_session("restart", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
    spark.sparkContext.setLogLevel("ERROR")
    staff = spark.read.csv({staff!r}, header=True, schema=schemas.staff())
    seen = order_monitor.run(spark, {landing!r}, staff, {out!r}, {checkpoint!r})
    print("COUNTS", len([p for p in seen.query.recentProgress if p["numInputRows"]]), seen.silver.count(),
          seen.dead.count())
"""


def test_restart_in_a_new_process_goes_on_without_duplicates(tmp_path):
    import os

    from tests.fixtures import write_staff_csv

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = textwrap.dedent(RESTART).format(
        repo=repo, staff=write_staff_csv(tmp_path / "staff.csv"), landing=str(tmp_path / "in"),
        out=str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"),
    )

    def run():
        done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        line = next(x for x in done.stdout.splitlines() if "COUNTS" in x)
        return line[line.index("COUNTS"):]

    write_csv(tmp_path / "in" / "a.csv", ORDERS[:10])
    assert run() == "COUNTS 1 10 0"
    write_csv(tmp_path / "in" / "b.csv", ORDERS[10:])
    assert run() == "COUNTS 1 14 1"


def test_monitor_equals_batch(spark, landing, tmp_path):
    seen = order_monitor.run(spark, landing, staff(spark), str(tmp_path / "out"), str(tmp_path / "cp"), max_files=1)
    assert (seen.silver.count(), seen.dead.count()) == (14, 1)
    assert round(seen.silver.agg(F.sum("amount")).first()[0], 2) == 7632.97
    assert rows(seen.dead, "order_id", "reasons") == [(1013, ["unknown_emp_id"])]
    again = order_monitor.run(spark, landing, staff(spark), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert (again.silver.count(), again.dead.count()) == (14, 1)


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    write = batch_slice_writer(str(tmp_path / "out"))
    write(spark.range(3), 0)
    write(spark.range(2), 1)
    write(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_cached_batch_reads_the_source_once(spark, landing, tmp_path):
    def two_actions(df, _):
        df.count()
        df.agg(F.sum("amount")).collect()

    def inputs(fn, name):
        query = run_available(orders_stream(spark, landing), str(tmp_path / name), batch=fn)
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    assert inputs(two_actions, "plain") == [30]
    assert inputs(cached_batch(two_actions), "cached") == [15]


def test_batch_ids_are_ordered(spark, landing, tmp_path):
    ids = []
    run_available(orders_stream(spark, landing, 1), str(tmp_path / "cp"), batch=lambda df, i: ids.append(i))
    assert ids == [0, 1, 2]


def test_progress_report(spark, landing, tmp_path):
    query = run_available(orders_stream(spark, landing, 1), str(tmp_path / "cp"), memory="prog")
    report = progress_report(spark, query)
    assert rows(report, "batch_id", "num_input_rows") == [(0, 5), (1, 5), (2, 5)]
    assert report.filter("add_batch_ms IS NULL OR trigger_ms < add_batch_ms").count() == 0


def test_progress_log_keeps_what_spark_forgets(spark, landing, tmp_path):
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "2")
    try:
        with progress_log(spark) as log:
            query = run_available(orders_stream(spark, landing, 1), str(tmp_path / "cp"), memory="logged")
            assert len(query.recentProgress) < 3
            report = progress_report(spark, query, log)
        assert rows(report, "batch_id", "num_input_rows") == [(0, 5), (1, 5), (2, 5)]
        with pytest.raises(ValueError):
            progress_report(spark, query)
    finally:
        spark.conf.unset(kept)


def test_stream_table_reads_a_file_or_a_folder(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    stream = stream_table(spark, str(tmp_path / "t.parquet"))
    run_available(stream, str(tmp_path / "c1"), memory="folder_rows")
    assert spark.table("folder_rows").count() == 10
    part = next((tmp_path / "t.parquet").glob("part-*.parquet"))
    run_available(stream_table(spark, str(part)), str(tmp_path / "c2"), memory="file_rows")
    assert spark.table("file_rows").count() == 10


def test_a_drain_that_runs_out_of_time_raises(spark, tmp_path):
    import time

    (tmp_path / "in").mkdir()
    spark.range(4).repartition(4).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = stream_files(spark, str(tmp_path / "in"), spark.range(1).schema, "parquet", 1)
    with pytest.raises(NotFinishedError):
        run_available(stream, str(tmp_path / "state"), timeout=1, batch=lambda df, i: time.sleep(3))
    assert not [q for q in spark.streams.active if q.isActive]
    # The next run goes on and is whole.
    seen = []
    run_available(stream, str(tmp_path / "state"), timeout=120, batch=lambda df, i: seen.extend(r["id"] for r in df.collect()))
    assert set(seen) <= {0, 1, 2, 3} and seen
