"""Intervals along a segment in place of polygon overlay: clip, cover and shared length against a union of shapes.

Each shape that a segment meets gives the part t_in..t_out of it; the union is never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geom import box_interval, length
from .spatial import grid_join, segment_box


def box_hits(segments: DataFrame, boxes: DataFrame, cell: float = 500.0, grown: float = 0.0) -> DataFrame:
    """segments' columns with t_in, t_out for every box (bx0, by0, bx1, by1) that shares more than a point with it."""
    box = (F.col("bx0") - grown, F.col("by0") - grown, F.col("bx1") + grown, F.col("by1") + grown)
    pairs = grid_join(segments, boxes, segment_box("x1", "y1", "x2", "y2"), box, cell)
    t_in, t_out = box_interval("x1", "y1", "x2", "y2", *box)
    return pairs.withColumn("t_in", t_in).withColumn("t_out", t_out).where("t_in < t_out")


def merged(hits: DataFrame, key: list[str]) -> DataFrame:
    """key, t0, t1: the islands of each key's intervals; touching ones are one."""
    w = Window.partitionBy(*key).orderBy("t_in", "t_out")
    upto = F.max("t_out").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = hits.select(*key, "t_in", "t_out").withColumn("new", F.when(upto >= F.col("t_in"), 0).otherwise(1))
    island = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("island", island).groupBy(*key, "island").agg(F.min("t_in").alias("t0"), F.max("t_out").alias("t1")).drop("island")


def clip(segments: DataFrame, boxes: DataFrame, key: list[str], least: float = 0.5, cell: float = 500.0) -> DataFrame:
    """The parts of segments inside the union of boxes that are longer than ``least``: key, t0, t1, metres."""
    islands = merged(box_hits(segments, boxes, cell), key)
    total = segments.select(*key, length().alias("_len"))
    return islands.join(total, key).withColumn("metres", (F.col("t1") - F.col("t0")) * F.col("_len")).where(F.col("metres") > least).drop("_len")


def covered(segments: DataFrame, boxes: DataFrame, key: list[str], slack: float = 0.01, cell: float = 500.0) -> DataFrame:
    """key, covered: whether one island of the boxes, grown by the slack, holds the whole segment."""
    islands = merged(box_hits(segments, boxes, cell, slack), key)
    whole = islands.groupBy(*key).agg(F.bool_or((F.col("t0") <= 0) & (F.col("t1") >= 1)).alias("covered"))
    return segments.select(*key).join(whole, key, "left").select(*key, F.coalesce("covered", F.lit(False)).alias("covered"))


COMMUNAL, PARCEL, AREA = "communal", "parcel", "area"
"""Kinds of boxes: public parcels, any parcels, service areas."""


def public_cover(segments: DataFrame, boxes: DataFrame, key: list[str], slack: float = 0.01, cell: float = 500.0) -> DataFrame:
    """key, covered: whether a segment lies on public ground: on communal boxes, or in an area and on no parcel.

    boxes: kind, bx0, by0, bx1, by1; without a kind all are communal.  Communal boxes and areas are grown by the slack, parcels
    shrunk by it.  The residual is decided piece by piece between the ends of a segment's intervals, never built.
    """
    if "kind" not in boxes.columns:
        return covered(segments, boxes, key, slack, cell)
    grow = F.when(F.col("kind") == PARCEL, -slack).otherwise(slack)
    sized = boxes.select("kind", (F.col("bx0") - grow).alias("bx0"), (F.col("by0") - grow).alias("by0"), (F.col("bx1") + grow).alias("bx1"), (F.col("by1") + grow).alias("by1"))
    # areas are far larger than parcels: a grid of their own keeps the number of cells small
    shapes = segments.select(*key, "x1", "y1", "x2", "y2")
    near = box_hits(shapes, sized.where(F.col("kind") != AREA), cell).select(*key, "kind", "t_in", "t_out")
    wide = box_hits(shapes, sized.where(F.col("kind") == AREA), max(cell, 2000.0)).select(*key, "kind", "t_in", "t_out")
    spans = near.unionByName(wide).groupBy(*key).agg(F.collect_list(F.struct("kind", "t_in", "t_out")).alias("s"))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.transform("s", lambda i: i["t_in"]), F.transform("s", lambda i: i["t_out"]))))
    listed = spans.withColumn("c", F.filter(cuts, lambda t: (t >= 0) & (t <= 1)))

    def on(kind: str, mid):
        return F.exists("s", lambda i: (i["kind"] == kind) & (i["t_in"] <= mid) & (mid <= i["t_out"]))

    middles = F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: (a + b) / 2)
    whole = listed.select(*key, F.forall(middles, lambda mid: on(COMMUNAL, mid) | (on(AREA, mid) & ~on(PARCEL, mid))).alias("covered"))
    return segments.select(*key).join(whole, key, "left").select(*key, F.coalesce("covered", F.lit(False)).alias("covered"))
