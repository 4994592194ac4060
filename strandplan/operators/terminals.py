"""Joining terminals to lines: anchors, splits at projections, stubs, and the audit of continuity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geom
from . import spatial

TOUCH, REACH, STUB, NODE_SNAP, EDGE_SNAP, AUDIT = 0.2, 5.0, 3.0, 50.0, 200.0, 1.0


def line_ends(lines: DataFrame, name: str = "seq") -> DataFrame:
    """node_seq, end (0, 1), nx, ny."""
    ends = F.array(F.struct(F.col("x1").alias("nx"), F.col("y1").alias("ny")), F.struct(F.col("x2").alias("nx"), F.col("y2").alias("ny")))
    return lines.select(F.col(name).alias("node_seq"), F.posexplode(ends).alias("end", "p")).select("node_seq", "end", "p.nx", "p.ny")


def nearest_end(points: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """seq, node_seq, end, d of the nearest line end within the radius (inclusive)."""
    pairs = spatial.grid_join(points, line_ends(lines), spatial.point_box("x", "y", radius), spatial.point_box("nx", "ny"), max(radius, 50.0))
    hit = pairs.select("seq", F.struct(geom.point_distance("x", "y", "nx", "ny").alias("d"), "node_seq", "end").alias("h")).where(F.col("h.d") <= radius)
    return hit.groupBy("seq").agg(F.min("h").alias("m")).select("seq", "m.node_seq", "m.end", "m.d")


def terminal_snap(points: DataFrame, lines: DataFrame) -> DataFrame:
    """seq, how, target: a line end under 50 m, else a projection under 200 m that splits its line, else none."""
    node = nearest_end(points, lines, NODE_SNAP).where(F.col("d") < NODE_SNAP).select("seq", F.lit("node").alias("how"), F.col("node_seq").alias("target"))
    left = points.join(node, "seq", "left_anti")
    edge = spatial.nearest(left, lines.withColumnRenamed("seq", "line_seq"), EDGE_SNAP, ["seq"], [F.col("line_seq")])
    edge = edge.where(F.col("best.d") < EDGE_SNAP).select("seq", F.lit("split").alias("how"), F.col("best.line_seq").alias("target"))
    found = node.unionByName(edge)
    return points.select("seq").join(found, "seq", "left").select("seq", F.coalesce("how", F.lit("missing")).alias("how"), "target")


def connections(points: DataFrame, lines: DataFrame) -> DataFrame:
    """seq, outcome, target: how each terminal meets the lines.

    connected: an end within 0.2 m; else the nearest line within 5 m is split where it passes, if that is between its ends:
    split if within 0.2 m, stub if within 3 m; too_far otherwise.
    """
    touch = nearest_end(points, lines, TOUCH).select("seq", F.lit("connected").alias("outcome"), F.col("node_seq").alias("target"))
    left = points.join(touch, "seq", "left_anti")
    named = lines.withColumnRenamed("seq", "line_seq")
    best = spatial.beside(left, named, REACH, 200.0).groupBy("seq").agg(F.min(F.struct("d", "line_seq", "t")).alias("m"))
    inner = (F.col("m.t") > 0) & (F.col("m.t") < 1)
    outcome = F.when(inner & (F.col("m.d") <= TOUCH), "split").when(inner & (F.col("m.d") <= STUB), "stub").otherwise("too_far")
    found = touch.unionByName(best.select("seq", outcome.alias("outcome"), F.col("m.line_seq").alias("target")))
    return points.select("seq").join(found, "seq", "left").select("seq", F.coalesce("outcome", F.lit("too_far")).alias("outcome"), "target")


def split_at(lines: DataFrame, cuts: DataFrame, least: float = 0.01) -> DataFrame:
    """seq, part, x1, y1, x2, y2: each line cut at all its cuts (seq, t) at once; cuts nearer than ``least`` to an end are passed over."""
    size = geom.length()
    ok = cuts.join(lines.select("seq", size.alias("_len")), "seq").where((F.col("t") * F.col("_len") >= least) & ((1 - F.col("t")) * F.col("_len") >= least))
    held = ok.groupBy("seq").agg(F.array_sort(F.collect_set("t")).alias("ts"))
    all_ts = F.concat(F.array(F.lit(0.0)), F.coalesce("ts", F.array().cast("array<double>")), F.array(F.lit(1.0)))
    parts = lines.join(held, "seq", "left").withColumn("ts", all_ts).select("seq", "x1", "y1", "x2", "y2", "ts", F.posexplode(F.slice("ts", 1, F.size("ts") - 1)).alias("part", "t0"))
    t1 = F.col("ts")[F.col("part") + 1]
    at = lambda t, a, b: geom.at(t, a, b)
    return parts.select("seq", "part", at(F.col("t0"), "x1", "x2").alias("px1"), at(F.col("t0"), "y1", "y2").alias("py1"), at(t1, "x1", "x2").alias("px2"), at(t1, "y1", "y2").alias("py2"))


def sanitised(vertices: Column) -> Column:
    """Vertices without those that are not finite and without repeats in a row; null if fewer than two are left."""
    finite = F.filter(vertices, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]) & (F.abs(p["x"]) < 1e300) & (F.abs(p["y"]) < 1e300))
    empty = F.array().cast("array<struct<x:double,y:double>>")
    kept = F.aggregate(finite, empty, lambda acc, p: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) == p), acc).otherwise(F.concat(acc, F.array(p))))
    return F.when(F.size(kept) >= 2, kept)
