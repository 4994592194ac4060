"""Planar geometry as column expressions: they stay in generated code, and no geometry type is needed.

Points are (x, y), segments (x1, y1, x2, y2), rectangles (x0, y0, x1, y1).  Distances follow one order of operations, so
that an SQL rendering of them gives equal doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def clamp_t(px, py, x1, y1, x2, y2) -> Column:
    """Where along the segment, 0 to 1, the nearest point to (px, py) is; 0 for a segment of no length."""
    px, py, x1, y1, x2, y2 = map(_c, (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = ((px - x1) * dx + (py - y1) * dy) / square
    return F.when(square == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), t)))


def point_distance(ax, ay, bx, by) -> Column:
    ax, ay, bx, by = map(_c, (ax, ay, bx, by))
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def at(t, a, b) -> Column:
    """The coordinate at t of a segment's a and b."""
    t, a, b = map(_c, (t, a, b))
    return a + t * (b - a)


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    t = clamp_t(px, py, x1, y1, x2, y2)
    return point_distance(px, py, at(t, x1, x2), at(t, y1, y2))


def length(x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    return point_distance(x1, y1, x2, y2)


def in_box(px, py, x0="x0", y0="y0", x1="x1", y1="y1", strict: bool = False) -> Column:
    px, py, x0, y0, x1, y1 = map(_c, (px, py, x0, y0, x1, y1))
    return (px > x0) & (px < x1) & (py > y0) & (py < y1) if strict else (px >= x0) & (px <= x1) & (py >= y0) & (py <= y1)


def box_distance(px, py, x0="x0", y0="y0", x1="x1", y1="y1") -> Column:
    """0 inside."""
    px, py, x0, y0, x1, y1 = map(_c, (px, py, x0, y0, x1, y1))
    dx = F.greatest(x0 - px, F.lit(0.0), px - x1)
    dy = F.greatest(y0 - py, F.lit(0.0), py - y1)
    return F.sqrt(dx * dx + dy * dy)


def key6(v) -> Column:
    """A coordinate's key: six decimals by plain arithmetic, as rounding differs between engines at ties."""
    return F.floor(_c(v) * 1e6 + 0.5) / 1e6


def box_interval(x1, y1, x2, y2, x0, y0, bx1, by1) -> tuple[Column, Column]:
    """The part t_in..t_out of a segment that is inside a rectangle; empty if t_in > t_out."""
    x1, y1, x2, y2, x0, y0, bx1, by1 = map(_c, (x1, y1, x2, y2, x0, y0, bx1, by1))
    lo, hi = [], []
    for p, q, a, b in ((x1, x2, x0, bx1), (y1, y2, y0, by1)):
        d = q - p
        inside = (p >= a) & (p <= b)
        lo.append(F.when(d == 0, F.when(inside, F.lit(0.0)).otherwise(F.lit(2.0))).otherwise(F.least((a - p) / d, (b - p) / d)))
        hi.append(F.when(d == 0, F.when(inside, F.lit(1.0)).otherwise(F.lit(-1.0))).otherwise(F.greatest((a - p) / d, (b - p) / d)))
    return F.greatest(F.lit(0.0), *lo), F.least(F.lit(1.0), *hi)


def orient(ax, ay, bx, by, cx, cy) -> Column:
    ax, ay, bx, by, cx, cy = map(_c, (ax, ay, bx, by, cx, cy))
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segments_cross(a: tuple, b: tuple) -> Column:
    """Whether two segments (x1, y1, x2, y2) cross in a point inside both."""
    o1, o2 = orient(*a, *b[:2]), orient(*a, *b[2:])
    o3, o4 = orient(*b, *a[:2]), orient(*b, *a[2:])
    return (o1 * o2 < 0) & (o3 * o4 < 0)


def capsule_interval(a: tuple, b: tuple, r: float) -> tuple[Column, Column]:
    """The part t_in..t_out of segment a within r of segment b (both x1, y1, x2, y2); empty if t_in > t_out.

    The capsule is convex, so the part is one interval: from the least entry to the greatest exit of its two discs and its strip.
    """
    ax, ay, bx, by = map(_c, a)
    cx, cy, ex, ey = map(_c, b)
    dx, dy = bx - ax, by - ay
    qa = dx * dx + dy * dy
    spans = []
    for px, py in ((cx, cy), (ex, ey)):
        fx, fy = ax - px, ay - py
        qb = fx * dx + fy * dy
        disc = qb * qb - qa * (fx * fx + fy * fy - r * r)
        root = F.sqrt(F.greatest(disc, F.lit(0.0)))
        ok = (disc >= 0) & (qa > 0)
        spans.append((F.when(ok, (-qb - root) / qa).otherwise(F.lit(2.0)), F.when(ok, (-qb + root) / qa).otherwise(F.lit(-1.0))))
    ux, uy = ex - cx, ey - cy
    size = F.sqrt(ux * ux + uy * uy)
    lo, hi = [F.lit(-1e9)], [F.lit(1e9)]
    for start, step, low, high in (
        ((ax - cx) * ux + (ay - cy) * uy, dx * ux + dy * uy, F.lit(0.0), size * size),
        ((ay - cy) * ux - (ax - cx) * uy, dy * ux - dx * uy, -r * size, r * size),
    ):
        inside = (start >= low) & (start <= high)
        lo.append(F.when(step == 0, F.when(inside, F.lit(-1e9)).otherwise(F.lit(1e9))).otherwise(F.least((low - start) / step, (high - start) / step)))
        hi.append(F.when(step == 0, F.when(inside, F.lit(1e9)).otherwise(F.lit(-1e9))).otherwise(F.greatest((low - start) / step, (high - start) / step)))
    enter, leave = F.greatest(*lo), F.least(*hi)
    strip = (size > 0) & (enter <= leave)
    spans.append((F.when(strip, enter).otherwise(F.lit(2.0)), F.when(strip, leave).otherwise(F.lit(-1.0))))
    return F.greatest(F.lit(0.0), F.least(*(s[0] for s in spans))), F.least(F.lit(1.0), F.greatest(*(s[1] for s in spans)))
