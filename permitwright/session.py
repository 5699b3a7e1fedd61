"""Session settings and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Sized for large clusters. Those of sql can also be set on a session that already exists.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed side even where that costs one more shuffle downstream: one hot key must never be one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The JVM does not compile methods of more than 8000 bytes; such a stage runs faster as several methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Checkpoints go when nothing refers to them any more, and are compressed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    # Building the larger expressions is several times faster without a Python stack trace per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "permits", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the runtime settings above; `settings` (dots as double underscores) win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Settings that are safe to apply to a session made elsewhere: none changes a result or a size its owner chose.
TUNED = [key for key in RUNTIME_SETTINGS if "skew" in key.lower() or "huge" in key]


def tune(spark: SparkSession) -> None:
    for key in TUNED:
        spark.conf.set(key, RUNTIME_SETTINGS[key])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, `spark.checkpoint.dir`. A session on one machine that sets none gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="permits-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
