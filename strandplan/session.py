"""Session helpers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


BATCH_ROWS = "1000"
"""Rows of an Arrow batch where the session has Spark's default of 10,000: rows hold whole texts, and a batch is held several times over."""


def ensure_importable(spark: SparkSession) -> SparkSession:
    """Let Python workers that share this file system import the package (elsewhere it is installed or sent by --py-files), and keep them small."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    env.setdefault("MALLOC_ARENA_MAX", "2")
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    return spark


def session() -> SparkSession:
    """The session of the cluster that Spark is set up for (spark-submit, spark-defaults), or of this machine."""
    return ensure_importable(SparkSession.builder.appName("strandplan").getOrCreate())


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_importable(spark)
