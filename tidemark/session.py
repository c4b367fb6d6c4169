"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job of this library runs with.  Sizes that depend on the
#: cluster (shuffle partitions, memory) are left to the submitter.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even where that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join without a condition is almost always a mistake; fail early.
    "spark.sql.crossJoin.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with the library defaults.

    Keyword names use ``__`` for the dots of a Spark setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Settings of DEFAULTS that change only how a session runs its joins, never results.
SKEW_SETTINGS = ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin")


def split_skewed_joins(spark: SparkSession) -> None:
    """Let AQE split skewed join inputs in a session built elsewhere."""
    for key in SKEW_SETTINGS:
        spark.conf.set(key, DEFAULTS[key])


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, because executors and a restarted driver have
    to reach the same files.  Only a local session gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one intermediate table inside the shared folder."""
    return os.path.join(checkpoint_root(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df):
    """Write ``df`` to the shared folder and read it back.

    Unlike executor-local blocks the files survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
