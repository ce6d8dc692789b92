"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query relies on; all can be changed on a running session.
RUNTIME_CONF = {
    # Dates and calendar parts must not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: join strategy from measured sizes, merged small
    # partitions, and hot join partitions split even when that costs a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join side is broadcast only when its measured size is below this.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Python operators exchange Arrow batches, kept small enough for wide texts.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}

# Settings fixed when a session starts: recording a call site for every
# expression makes wide plans slow to build.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "touchline", master: str | None = None, **conf: str) -> SparkSession:
    """Session for the command-line jobs. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in START_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, named by ``spark.checkpoint.dir``.

    Unset is accepted only in local mode, where one machine is the cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="touchline-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh sub-folder name in the shared folder, never reused between runs."""
    return os.path.join(shared_dir(spark), "touchline", f"{name}-{uuid.uuid4().hex}")
