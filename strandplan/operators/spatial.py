"""Spatial joins on a grid: an equi-join on cells that each shape's box touches, then the exact predicate.

A pair whose boxes share several cells is kept in one of them only, the cell of the greater lower-left corner, so
no distinct is needed.  No side is broadcast or crossed; a crowded cell is a skewed key that AQE splits.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geom import at, clamp_t, point_distance, segment_distance
from ..graphs import checkpointed, few

Box = tuple[Column, Column, Column, Column]
Shape = tuple[str, str, str, str]


def point_box(x: str, y: str, r: float = 0.0) -> Box:
    return F.col(x) - r, F.col(y) - r, F.col(x) + r, F.col(y) + r


def segment_box(x1: str, y1: str, x2: str, y2: str, r: float = 0.0) -> Box:
    return F.least(x1, x2) - r, F.least(y1, y2) - r, F.greatest(x1, x2) + r, F.greatest(y1, y2) + r


def _celled(df: DataFrame, box: Box, cell: float) -> DataFrame:
    lo = [F.floor(c / cell) for c in box[:2]]
    hi = [F.floor(c / cell) for c in box[2:]]
    return df.withColumn("_cx", F.explode(F.sequence(lo[0], hi[0]))).withColumn("_cy", F.explode(F.sequence(lo[1], hi[1])))


def grid_join(left: DataFrame, right: DataFrame, left_box: Box, right_box: Box, cell: float, on: list[str] | None = None) -> DataFrame:
    """Pairs of rows whose boxes meet (edges included), with equal values of ``on``; other column names must differ.

    Boxes are expressions on their own side's columns; they are computed again after the join, so that a shuffled row holds its columns
    and its cell only.  The merge hint keeps Spark from broadcasting a side because its file is small: what it reads from that may be
    fifty times as large (a side of ``few`` rows is broadcast all the same).  Choose the cell near twice the larger of the search radius and the usual box.
    """
    keys = list(on or [])
    pairs = _celled(left, left_box, cell).join(_celled(right, right_box, cell).hint("merge"), [*keys, "_cx", "_cy"])
    once = [F.floor(F.greatest(a, b) / cell) == F.col(c) for a, b, c in zip(left_box[:2], right_box[:2], ("_cx", "_cy"), strict=True)]
    meet = (left_box[0] <= right_box[2]) & (right_box[0] <= left_box[2]) & (left_box[1] <= right_box[3]) & (right_box[1] <= left_box[3])
    return pairs.where(meet & once[0] & once[1]).drop("_cx", "_cy")


def computed(df: DataFrame, **values: Column) -> DataFrame:
    """df with columns computed once a row, one after the other, in generated methods of their own.

    A column of a join's condition is written out wherever it is named, which makes methods of over 8000 bytes, and the JVM never compiles those.
    """
    for name, value in values.items():
        df = df.withColumn(name, F.explode(F.array(value)))
    return df


def beside(points: DataFrame, lines: DataFrame, radius: float, cell: float, on: list[str] | None = None) -> DataFrame:
    """Pairs of points (x, y) and segments (x1, y1, x2, y2) no further apart than the radius, with t and d of the nearest place.

    A point is in one cell, a segment in those that it passes within the radius, so pairs meet once.  Before the exact distance a test of
    the distance from the line's direction, a hundredth wider, turns most pairs down.
    """
    keys = list(on or [])
    x1, y1, x2, y2 = map(F.col, ("x1", "y1", "x2", "y2"))
    reach = radius + 0.01
    lo, hi = F.least(x1, x2), F.greatest(x1, x2)
    within = [F.least(hi, F.greatest(lo, c)) for c in (F.col("_cx") * cell - reach, (F.col("_cx") + 1) * cell + reach)]
    ys = [F.when(x1 == x2, y).otherwise(y1 + (w - x1) * ((y2 - y1) / (x2 - x1))) for w, y in zip(within, (y1, y2), strict=True)]
    passed = lines.withColumn("_cx", F.explode(F.sequence(F.floor((lo - reach) / cell), F.floor((hi + reach) / cell))))
    passed = passed.withColumn("_cy", F.explode(F.sequence(F.floor((F.least(*ys) - reach) / cell), F.floor((F.greatest(*ys) + reach) / cell))))
    own = points.withColumns({"_cx": F.floor(F.col("x") / cell), "_cy": F.floor(F.col("y") / cell)})
    x, y = F.col("x"), F.col("y")
    close = (x >= lo - reach) & (x <= hi + reach) & (y >= F.least(y1, y2) - reach) & (y <= F.greatest(y1, y2) + reach)
    close = close & (F.abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) <= reach * 1.01 * (F.abs(x2 - x1) + F.abs(y2 - y1)))
    pairs = own.join(passed.hint("merge"), [*keys, "_cx", "_cy"]).where(close).drop("_cx", "_cy")
    return computed(pairs, t=clamp_t("x", "y", "x1", "y1", "x2", "y2"), d=point_distance("x", "y", at("t", "x1", "x2"), at("t", "y1", "y2"))).where(F.col("d") <= radius)


RINGS, RING_FROM = (8, 3), 200.0
"""Parts of a search radius that are tried first, for radii that are large beside the usual distance."""


def nearest(points: DataFrame, segments: DataFrame, radius: float, key: list[str], order: list[Column], on: list[str] | None = None, exact: bool = True) -> DataFrame:
    """For each point (key, x, y) the nearest segment (x1, y1, x2, y2, and what order names) whose box meets the radius.

    Adds ``best``: struct (d, *order, qx, qy), least distance first, then order.  exact: only within the radius; else a segment
    whose box meets the circle's box may be further away.  Points without any are left out.  A large radius is searched in
    rings: a point that has a segment within a part of it is done, and only the others look further.
    """
    found, left = None, points
    for part in RINGS if radius >= RING_FROM else ():
        ring = checkpointed(_within(left, segments, radius / part, key, order, on, True))
        found = ring if found is None else found.unionByName(ring)
        left = few(left.join(ring.select(*key), key, "left_anti"))
    last = _within(left, segments, radius, key, order, on, exact)
    return last if found is None else found.unionByName(last)


def _within(points: DataFrame, segments: DataFrame, radius: float, key: list[str], order: list[Column], on: list[str] | None, exact: bool) -> DataFrame:
    pairs = grid_join(points, segments, point_box("x", "y", radius), segment_box("x1", "y1", "x2", "y2"), max(2 * radius, 50.0), on)
    pairs = computed(pairs, _t=clamp_t("x", "y", "x1", "y1", "x2", "y2"), _d=point_distance("x", "y", at("_t", "x1", "x2"), at("_t", "y1", "y2")))
    if exact:
        pairs = pairs.where(F.col("_d") <= radius)
    q = [at("_t", a, b).alias(n) for a, b, n in (("x1", "x2", "qx"), ("y1", "y2", "qy"))]
    return pairs.groupBy(*key).agg(F.min(F.struct(F.col("_d").alias("d"), *order, *q)).alias("best"))


def nearest_of_all(points: DataFrame, targets: DataFrame, start: float, on: list[str] | None = None) -> DataFrame:
    """seq, tseq of the nearest of all targets (tseq, tx, ty) with equal ``on``, by a radius that grows for those still without one.

    Points whose ``on`` no target has are left out.
    """
    keys = list(on or [])
    left, found, radius = points, None, start
    left = checkpointed(left.join(targets.select(*keys).distinct(), keys, "left_semi") if keys else left)
    if targets.isEmpty():
        left = left.limit(0)
    while True:
        pairs = grid_join(left, targets, point_box("x", "y", radius), point_box("tx", "ty"), radius, keys)
        hit = pairs.select("seq", F.struct(point_distance("x", "y", "tx", "ty").alias("d"), "tseq").alias("h")).where(F.col("h.d") <= radius).groupBy("seq").agg(F.min("h").alias("m"))
        hit = checkpointed(hit.select("seq", F.col("m.tseq").alias("tseq")))
        found = hit if found is None else found.unionByName(hit)
        left = checkpointed(left.join(hit, "seq", "left_anti"))
        if left.isEmpty():
            return found
        radius *= 4


def near_twins(left: DataFrame, right: DataFrame, a: Shape, b: Shape, most: float, on: list[str]) -> DataFrame:
    """Pairs of segments whose ends are all within ``most`` of the other: candidates have both ends of the one within 1.5 * most of those of the other, in one order.

    Along a's direction both ends of b are between ``most`` before a's first end and ``most`` after its last one, and, as a's ends are within
    most of b, one of them is not further than that from either; sideways none is further than most.  So they are within 1.42 * most.
    The cells are those of both ends at once.  Segments are taken from left to right; only where that is not clear the right side is in both orders.
    """
    reach, cell = 1.5 * most, 40 * most
    forward = [F.col(s[0]) <= F.col(s[2]) for s in (a, b)]
    p = [F.when(forward[0], F.col(a[i])).otherwise(F.col(a[i - 2])) for i in range(4)]
    lefts = left
    for i in range(4):
        lefts = lefts.withColumn(f"_c{i}", F.explode(F.sequence(F.floor((p[i] - 1.1 * reach) / cell), F.floor((p[i] + 1.1 * reach) / cell))))
    lefts = lefts.select(*left.columns, F.xxhash64(*(f"_c{i}" for i in range(4))).alias("_cell"))
    unclear = F.abs(F.col(b[0]) - F.col(b[2])) <= 4 * reach
    rights = right.withColumn("_turned", F.explode(F.when(unclear, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    q = [[F.when(way, F.col(b[i])).otherwise(F.col(b[i - 2])) for i in range(4)] for way in (forward[1] != F.col("_turned"), forward[1])]
    rights = rights.withColumn("_cell", F.xxhash64(*(F.floor(c / cell) for c in q[0])))
    near, first = (reduce(and_, (F.abs(m - n) <= reach for m, n in zip(p, o, strict=True))) for o in q)
    pairs = lefts.join(rights.hint("merge"), [*on, "_cell"]).where(near & (~F.col("_turned") | ~first)).drop("_cell", "_turned")
    for i, (e, s) in enumerate(((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))):
        pairs = computed(pairs, **{f"_t{i}": clamp_t(*e, *s), f"_d{i}": point_distance(*e, at(f"_t{i}", s[0], s[2]), at(f"_t{i}", s[1], s[3]))}).where(F.col(f"_d{i}") <= most)
    return pairs.select(*left.columns, *(c for c in right.columns if c not in on))


def close_pairs(points: DataFrame, node: str, radius: float, on: list[str] | None = None) -> DataFrame:
    """a, b: pairs of points (node, x, y), a < b, no further apart than the radius (inclusive)."""
    keys = list(on or [])
    left = points.select(*keys, F.col(node).alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = points.select(*keys, F.col(node).alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    pairs = grid_join(left, right, point_box("ax", "ay", radius), point_box("bx", "by"), radius, keys)
    return pairs.where((F.col("a") < F.col("b")) & (point_distance("ax", "ay", "bx", "by") <= radius)).select(*keys, "a", "b")
