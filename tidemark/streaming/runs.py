"""Starting, draining and observing streaming queries."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.layout import reused

PROGRESS = (
    "batch_id bigint, num_input_rows bigint, input_rows_per_second double, processed_rows_per_second double, "
    "rows_dropped_late bigint, trigger_ms bigint, add_batch_ms bigint, latest_offset_ms bigint, wal_commit_ms bigint, "
    "falling_behind boolean"
)


def start(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    batch: Callable[[DataFrame, int], None] | None = None,
    memory: str | None = None,
    console: bool = False,
    mode: str = "append",
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query into exactly one sink.

    Sinks: Parquet files at ``path``, a ``batch`` function, an in-memory table
    named ``memory`` or the ``console`` (the last two for tests and looking).
    Triggers: ``every`` an interval (the first batch comes at once), once over
    all that is ``available_now``, or by default as soon as data is there.
    A restart with the same checkpoint goes on where the last run committed.
    """
    if sum([path is not None, batch is not None, memory is not None, console]) != 1:
        raise ValueError("name exactly one sink")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    if path is not None:
        return writer.format("parquet").start(path)
    if batch is not None:
        return writer.foreachBatch(batch).start()
    if memory is not None:
        return writer.format("memory").queryName(memory).start()
    return writer.format("console").start()


class NotFinishedError(TimeoutError):
    """A drain was stopped before it had processed everything; its sink is not whole."""


def run_available(df: DataFrame, checkpoint: str, timeout: int | None = None, **sink) -> StreamingQuery:
    """Process everything present and stop; sinks and mode as for ``start``.

    A drain that is not through after ``timeout`` seconds is stopped and
    raises, as its sink holds only a part; a later run with the same checkpoint
    goes on from there.
    """
    query = start(df, checkpoint, available_now=True, **sink)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise NotFinishedError(f"not finished after {timeout} s; the last batch was {(query.lastProgress or {}).get('batchId')}")
    return query


def cached_batch(fn: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Keep a micro-batch while ``fn`` runs several actions on it.

    Otherwise each action reads the source again.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        with reused(df) as kept:
            fn(kept, batch_id)

    return handle


class ProgressLog(StreamingQueryListener):
    """Progress of every trigger by run; Spark itself keeps only the newest ones."""

    def __init__(self):
        self.runs: dict[str, list[dict]] = {}
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def end(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = json.loads(event.progress.json)
        self.runs.setdefault(p["runId"], []).append(p)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.end(str(event.runId)).set()

    def of(self, query: StreamingQuery, timeout: int = 60) -> list[dict]:
        """All triggers of a stopped query, once Spark has told of its end."""
        if query.isActive:
            raise ValueError("stop the query first: events of its last triggers may be on their way")
        if not self.end(str(query.runId)).wait(timeout):
            raise TimeoutError(f"the end of run {query.runId} was not told within {timeout} s")
        return self.runs.get(str(query.runId), [])


@contextmanager
def progress_log(spark: SparkSession) -> Iterator[ProgressLog]:
    """Records the queries started inside; read it inside too, with ``progress_report``."""
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def progress_report(spark: SparkSession, query: StreamingQuery, log: ProgressLog | None = None) -> DataFrame:
    """One row per finished trigger: rows, rates, phases, and whether input outruns processing.

    With a ``log`` these are all triggers of a stopped query.  Without one they
    are those Spark remembers; where it may have forgotten some, this raises.
    """
    rows = []
    if log is None:
        told = query.recentProgress
        # Spark drops the oldest as soon as so many are there, which leaves one less.
        if len(told) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")) - 1:
            raise ValueError("Spark may have forgotten older triggers; start the query inside progress_log")
    else:
        told = log.of(query)
    for p in told:
        phases = p["durationMs"]
        came, done = p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond")
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"])
        rows.append(
            (
                p["batchId"], p["numInputRows"], came, done, late, phases.get("triggerExecution"),
                phases.get("addBatch"), phases.get("latestOffset"), phases.get("walCommit"),
                came is not None and done is not None and came > done,
            )
        )
    return spark.createDataFrame(rows, PROGRESS)
