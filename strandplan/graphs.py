"""Graph primitives on edge tables: components, degrees."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which executors share; one of its own only where Spark runs on one machine and none is set."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
            import tempfile

            where = tempfile.mkdtemp(prefix="strandplan-checkpoint-")
        sc.setCheckpointDir(where)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the checkpoint folder."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """df, written to the checkpoint folder in compressed columns, and what deletes it once nothing reads it: for wide rows, of which a checkpoint writes every byte."""
    spark = df.sparkSession
    where = f"{_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(where)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return spark.read.schema(df.schema).parquet(where), lambda: path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that nothing refers to any more go now, not at some later collection of garbage: it takes two or three, as
    one ends plans, which hold the shuffles that the next ends, and the files go on another thread."""
    alone = spark.sparkContext.master.startswith("local[")  # then nothing else has to be waited for
    for _ in range(1 if alone else 3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.0 if alone else 1.0)


FEW = 100_000
"""Rows up to which a table goes to every task instead of being shuffled: they are counted, never guessed."""


def few(df: DataFrame) -> DataFrame:
    """df, checkpointed, and broadcast to joins if it has few rows."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= FEW else df


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge table.

    Alternates large-star and small-star rounds: each round hangs nodes on the smallest neighbour known, so the
    number of rounds grows with the logarithm of the diameter and the number of edges never grows.  Only minima
    by node are aggregated, so a hub costs one partial aggregate a task.  Null ends are ignored; no edges: no rows.
    """
    x, y = F.col(a), F.col(b)
    pairs = checkpointed(edges.where(x.isNotNull() & y.isNotNull()).select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi")))
    now = checkpointed(pairs.where("lo <> hi").distinct())
    alone = pairs.where("lo = hi").select(F.col("lo").alias("node"))
    nodes = pairs.select(F.col("lo").alias("node")).union(pairs.select("hi")).union(alone).distinct()
    mark_of = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")), F.bit_xor(F.xxhash64("hi", F.lit(1), "lo"))).first()
    last = mark_of(now)
    while True:
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(now.select("hi", "lo"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo <> hi").distinct()
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select("m", "u", "v")
        after = checkpointed(
            small.select(F.col("m").alias("lo"), F.col("v").alias("hi")).union(small.select("m", "u")).where("lo <> hi").distinct()
        )
        # the same edges as before, by their number and 128 bits of hash: nothing has to be shuffled to compare them
        now, mark = after, mark_of(after)
        if mark == last:
            break
        last = mark
    roots = now.groupBy("hi").agg(F.min("lo").alias("component")).withColumnRenamed("hi", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
