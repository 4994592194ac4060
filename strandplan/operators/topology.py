"""Clean-up and audit of routed lines: duplicates, support switches, gaps, and the purge of broken paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..graphs import checkpointed, connected_components
from .spatial import close_pairs

PURGE_ROUNDS = 5


def duplicates_merged(rows: DataFrame, key: list[str], rank: list[Column], path: str, keep: list[str]) -> DataFrame:
    """One row for each undirected endpoint pair, whatever lies between: the best-ranked, with all the paths."""
    w = Window.partitionBy(*key)
    marked = rows.withColumn("_rn", F.row_number().over(w.orderBy(*rank)))
    paths = F.array_join(F.array_sort(F.collect_set(F.col(path).cast("string"))), "|")
    best = [F.min_by(c, "_rn").alias(c) for c in keep]
    return marked.groupBy(*key).agg(*best, paths.alias("_used_by_paths"), (F.count("*") - 1).alias("n_removed"))


def support_switches(rows: DataFrame, chain: list[str], order: str, family: Column) -> DataFrame:
    """Of each chain: adjacent changes of family, and the families that come back after another."""
    fam = rows.withColumn("_f", family).where("_f is not null")
    w = Window.partitionBy(*chain).orderBy(order)
    runs = fam.withColumn("_new", F.coalesce((F.col("_f") != F.lag("_f").over(w)).cast("int"), F.lit(1)))
    by_family = runs.groupBy(*chain, "_f").agg(F.sum("_new").alias("runs"))
    return by_family.groupBy(*chain).agg((F.sum("runs") - 1).alias("switches"), F.count_if(F.col("runs") > 1).alias("suspicious"))


def micro_gaps(points: DataFrame, node: str, component: str, radius: float, on: list[str] | None = None) -> DataFrame:
    """a, b: nodes of different components that are no further apart than the radius."""
    pairs = close_pairs(points, node, radius, on).select("a", "b")
    left = points.select(F.col(node).alias("a"), F.col(component).alias("ca"))
    right = points.select(F.col(node).alias("b"), F.col(component).alias("cb"))
    return pairs.join(left, "a").join(right, "b").where("ca <> cb").select("a", "b")


def purged(rows: DataFrame, anchors: DataFrame, rounds: int = PURGE_ROUNDS) -> DataFrame:
    """rows (a, b, path, ...) left when broken paths are dropped again and again; anchors: path, pa_node, pb_node.

    A path is reachable if both its anchors are in one component of the rows that are left; a row of other paths goes, which
    may break further paths.  Ends when a round drops nothing, or after ``rounds``.
    """
    now = checkpointed(rows)
    for _ in range(rounds):
        of = connected_components(now.select("a", "b"))
        pa = of.select(F.col("node").alias("pa_node"), F.col("component").alias("c1"))
        pb = of.select(F.col("node").alias("pb_node"), F.col("component").alias("c2"))
        good = anchors.join(pa, "pa_node").join(pb, "pb_node").where("c1 = c2").select("path").distinct()
        left = checkpointed(now.join(good, "path", "left_semi").select(*now.columns))
        same = left.count() == now.count()
        now = left
        if same:
            break
    return now


def block_running_count(rows: DataFrame, order: str, flag: Column, block: int = 100_000) -> DataFrame:
    """rows with ``running``: how many rows up to each, in the order of a whole number, are flagged.

    Counts by block of that number and their sums before each block come first, so no task has to hold all rows.
    """
    marked = rows.withColumn("_flag", flag.cast("long")).withColumn("_block", F.floor(F.col(order) / block))
    sums = marked.groupBy("_block").agg(F.sum("_flag").alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    local = F.sum("_flag").over(Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_local", local).join(before, "_block").withColumn("running", F.col("_before") + F.col("_local")).drop("_flag", "_block", "_local", "_before")
