"""Spark session helpers.

The library never creates a cluster session on its own; jobs receive the
session their launcher built. ``local_session`` exists for tests, the bench
and the smoke entry point.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (dates are rendered as text),
# adaptive execution for coalescing, skew splitting and runtime broadcast.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "threadsift") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it.
    When it is unset, a local session (tests, benches) gets a fresh scratch
    folder; on a cluster this raises, since a folder of one machine would
    not be seen by the others.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="threadsift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured
