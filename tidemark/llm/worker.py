"""What the functions in Python workers share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Rows in an Arrow batch: rows here carry whole texts or shingle sets, and the default of 10,000 of them is
#: held by the JVM and by Python at the same time, for every core.
BATCH_ROWS = "1000"
#: Bytes in an Arrow batch, whatever comes first: a batch of very long texts has few rows.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python workers in batches of bounded memory; results do not change.

    The session keeps these settings: plans made here run later, when the caller asks for their rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def remembered(name: str, make: Callable):
    """``make()``, made once per Python worker and kept for its later tasks.

    Functions travel by value and bring their own globals with each task; a
    module that is looked up by name is the same for all of them.  Only the
    last one is kept: a worker that goes on to another job lets go of the old.
    """
    memory = sys.modules.setdefault("tidemark_worker_memory", types.ModuleType("tidemark_worker_memory"))
    if getattr(memory, "name", None) != name:
        memory.made = None
        memory.made, memory.name = make(), name
    return memory.made
