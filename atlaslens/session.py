"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only: every one of these can be changed on a live session.
RUNTIME_SETTINGS = {
    # Timestamps without zone are read as UTC, so results do not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join key holding a large share of the rows is split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Session windows are merged before the shuffle, so a hot key travels as a few rows per task.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Pages can be megabytes long; batches are bounded by bytes, not by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # State of streams lies on disk, not in the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created, except those its owner has set."""
    theirs = spark.conf.getAll
    for key, value in RUNTIME_SETTINGS.items():
        if key not in theirs:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "atlaslens", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or get) a session with the runtime settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
