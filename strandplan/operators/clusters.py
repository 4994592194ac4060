"""Clusters of points: by distance, by capacity, by weighted k-means."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geom import key6, point_distance
from ..graphs import checkpointed, connected_components
from .spatial import computed

MIN_SOCKETS, MAX_SOCKETS, MAX_BRANCH_SOCKETS, KMEANS_ROUNDS = 50.0, 120.0, 10.0, 50


BLOCK = 8
"""Cells along a side of the blocks in which neighbouring cells meet."""


def _linked(points: DataFrame, node: str, radius: float, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """points with their cell (_gx, _gy); the cells with rep, box, n, sx, sy (sums of places); and rep, component of the cells that have others in reach.

    Points of one grid cell of diagonal under the radius are one cluster already, so cells are linked, not points: by their points' boxes
    where those tell, else (``_met``) by smaller cells in them.  A crowded area costs its cells, not the square of its points.
    """
    side = radius / 1.4143
    celled = points.withColumns({"_gx": F.floor(F.col("x") / side), "_gy": F.floor(F.col("y") / side)})
    corner = [f(c).alias(n) for f, c, n in ((F.min, "x", "x0"), (F.min, "y", "y0"), (F.max, "x", "x1"), (F.max, "y", "y1"))]
    cells = checkpointed(celled.groupBy(*keys, "_gx", "_gy").agg(F.min(node).alias("rep"), *corner, F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy")))
    box = ["_gx", "_gy", "rep", "x0", "y0", "x1", "y1"]
    block = lambda c: F.floor(c / BLOCK)
    # the right side is in its own block, the left one in all that hold cells ahead of it: up to two on, and two to either side
    left = cells.select(*keys, *(F.col(c).alias("a_" + c) for c in box)).withColumn("_bx", F.explode(F.sequence(block(F.col("a__gx")), block(F.col("a__gx") + 2)))).withColumn("_by", F.explode(F.sequence(block(F.col("a__gy") - 2), block(F.col("a__gy") + 2))))
    right = cells.select(*keys, *(F.col(c).alias("b_" + c) for c in box), block(F.col("_gx")).alias("_bx"), block(F.col("_gy")).alias("_by"))
    dx, dy = F.col("b__gx") - F.col("a__gx"), F.col("b__gy") - F.col("a__gy")
    pairs = left.join(right, [*keys, "_bx", "_by"]).where((dx >= 0) & (dx <= 2) & (dy >= -2) & (dy <= 2) & ((dx > 0) | (dy > 0)))
    gap = {f"_{c}": F.greatest(F.lit(0.0), F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.col(f"a_{c}0") - F.col(f"b_{c}1")) for c in "xy"}
    span = [F.greatest(F.col(f"b_{c}1") - F.col(f"a_{c}0"), F.col(f"a_{c}1") - F.col(f"b_{c}0")) for c in "xy"]
    pairs = computed(pairs, **gap).where(F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")) <= radius)
    pairs = checkpointed(pairs.select("a_rep", "b_rep", (F.sqrt(span[0] * span[0] + span[1] * span[1]) <= radius).alias("sure")))
    links, open_ = pairs.where("sure").select("a_rep", "b_rep"), pairs.where("not sure").select("a_rep", "b_rep")
    if not open_.isEmpty():
        asked = open_.select(F.col("a_rep").alias("rep")).union(open_.select("b_rep")).distinct()
        of = cells.join(asked, "rep", "left_semi").select(*keys, "_gx", "_gy", "rep")
        member = checkpointed(celled.select(*keys, "_gx", "_gy", "x", "y").join(of, [*keys, "_gx", "_gy"]).select("rep", "x", "y"))
        links = links.union(_met(open_, member, side, radius))
    return celled, cells, connected_components(links, "a_rep", "b_rep").withColumnRenamed("node", "rep")


def distance_clusters(points: DataFrame, node: str, radius: float, on: list[str] | None = None) -> DataFrame:
    """points with cluster: the smallest node that chains of steps up to the radius (inclusive) reach."""
    keys = list(on or [])
    celled, cells, found = _linked(points, node, radius, keys)
    named = cells.select(*keys, "_gx", "_gy", "rep").join(found, "rep", "left").select(*keys, "_gx", "_gy", F.coalesce("component", "rep").alias("cluster"))
    return celled.join(named, [*keys, "_gx", "_gy"]).select(*points.columns, "cluster")


DIRECT = 4096
"""Pairs of points of two cells that are compared at once; more are cut into smaller cells first."""


def _met(open_: DataFrame, member: DataFrame, side: float, radius: float) -> DataFrame:
    """Of pairs of cells (a_rep, b_rep) those with points (rep, x, y) near enough.

    Cells of few points are compared point by point.  The others are cut into 16; pairs of boxes tell most, and what is left open is
    cut again, down to boxes of one place.  What a pair of cells costs so does not grow with its points.
    """
    size = member.groupBy("rep").agg(F.count("*").alias("n"))
    sized = open_.join(size.toDF("a_rep", "na"), "a_rep").join(size.toDF("b_rep", "nb"), "b_rep")
    todo = checkpointed(sized.select("a_rep", "b_rep", (F.col("na") * F.col("nb") <= DIRECT).alias("few")))
    ends = [member.select(F.col("rep").alias(f"{s}_rep"), F.col("x").alias(f"{s}x"), F.col("y").alias(f"{s}y")) for s in "ab"]
    few = todo.where("few").join(ends[0], "a_rep").join(ends[1], "b_rep")
    out = few.where(point_distance("ax", "ay", "bx", "by") <= radius).select("a_rep", "b_rep").distinct()
    many = todo.where("not few").select("a_rep", "b_rep")
    up: list[str] = []
    while not many.isEmpty():
        side /= 4
        grid = [F.floor(F.col(c) / side).alias(f"g{c}") for c in "xy"]
        above = [F.floor(F.col(c) / (4 * side)).alias(f"u{c}") for c in "xy"]
        boxes = member.select("rep", "x", "y", *grid, *above).groupBy("rep", "gx", "gy", "ux", "uy").agg(*(f(c).alias(n) for f, c, n in ((F.min, "x", "x0"), (F.min, "y", "y0"), (F.max, "x", "x1"), (F.max, "y", "y1"))))
        named = [boxes.select(*(F.col(c).alias(f"{s}_{c}") for c in boxes.columns)) for s in "ab"]
        pairs = many.join(named[0], ["a_rep", *(f"a_{u}" for u in up)]).join(named[1], ["b_rep", *(f"b_{u}" for u in up)])
        gap = [F.greatest(F.lit(0.0), F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.col(f"a_{c}0") - F.col(f"b_{c}1")) for c in "xy"]
        span = [F.greatest(F.col(f"b_{c}1") - F.col(f"a_{c}0"), F.col(f"a_{c}1") - F.col(f"b_{c}0")) for c in "xy"]
        near, far = (F.sqrt(d[0] * d[0] + d[1] * d[1]) for d in (gap, span))
        pairs = checkpointed(pairs.where(near <= radius).select("a_rep", "b_rep", *(F.col(f"{s}_g{c}") for s in "ab" for c in "xy"), (far <= radius).alias("sure")))
        sure = pairs.where("sure").select("a_rep", "b_rep").distinct()
        out = out.union(sure)
        left = pairs.where("not sure").join(sure, ["a_rep", "b_rep"], "left_anti")
        many = checkpointed(left.select("a_rep", "b_rep", *(F.col(f"{s}_g{c}").alias(f"{s}_u{c}") for s in "ab" for c in "xy")).distinct())
        up = ["ux", "uy"]
    return out


def _mean(n: Column, sx: Column, sy: Column) -> list[Column]:
    return [key6(sx / n).alias("wx"), key6(sy / n).alias("wy")]


def welded(points: DataFrame, node: str, radius: float, on: list[str] | None = None) -> DataFrame:
    """points with cluster and wx, wy, the cluster's mean place to six decimals."""
    keys = list(on or [])
    celled, cells, found = _linked(points, node, radius, keys)
    named = cells.select(*keys, "_gx", "_gy", "rep", "n", "sx", "sy").join(found, "rep", "left").withColumn("cluster", F.coalesce("component", "rep"))
    centre = named.groupBy("cluster").agg(*_mean(F.sum("n"), F.sum("sx"), F.sum("sy")))
    of = named.select(*keys, "_gx", "_gy", "cluster").join(centre, "cluster")
    return celled.join(of, [*keys, "_gx", "_gy"]).select(*points.columns, "cluster", "wx", "wy")


def moving_cells(points: DataFrame, node: str, radius: float, on: list[str]) -> DataFrame:
    """(on, _gx, _gy, wx, wy) of the cells of radius / 1.4143 whose points weld to another place than their own to six decimals: those of several places or in reach of others."""
    _, cells, found = _linked(points, node, radius, on)
    tied = checkpointed(cells.join(found, "rep").select(*on, "_gx", "_gy", "n", "sx", "sy", "component"))
    centre = tied.groupBy("component").agg(*_mean(F.sum("n"), F.sum("sx"), F.sum("sy")))
    apart = cells.where("x0 < x1 or y0 < y1").join(tied.select(*on, "_gx", "_gy"), [*on, "_gx", "_gy"], "left_anti")
    return tied.join(centre, "component").select(*on, "_gx", "_gy", "wx", "wy").union(apart.select(*on, "_gx", "_gy", *_mean(F.col("n"), F.col("sx"), F.col("sy"))))


def weighted_centroids(points: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """Weighted mean place of each group; the plain mean if all weights are 0 or less."""
    w = points.withColumn("_w", weight)
    total = F.sum("_w")
    mean = lambda c: F.when(total > 0, F.sum(F.col("_w") * F.col(c)) / total).otherwise(F.avg(c)).alias(f"c{c}")
    return w.groupBy(*by).agg(mean("x"), mean("y"), total.alias("weight"), F.count("*").alias("n"))


def merge_small(clusters: list[tuple[float, float, float, list]], least: float = MIN_SOCKETS) -> list[tuple[float, float, float, list]]:
    """(weight, cx, cy, members) in order, a light one joined to the nearest of all others.

    The join takes place only if that nearest one stands earlier and has not been changed by a join; else the light one stays.
    """
    out: list[tuple[float, float, float, list]] = []
    changed: set[int] = set()
    at: dict[int, int] = {}
    for i, (w, x, y, members) in enumerate(clusters):
        others = [(math.hypot(x - o[1], y - o[2]), j) for j, o in enumerate(clusters) if j != i]
        if w < least and others:
            j = min(others)[1]
            if j in at and j not in changed:
                k = at[j]
                total = out[k][0] + w
                cx, cy = ((out[k][0] * out[k][1] + w * x) / total, (out[k][0] * out[k][2] + w * y) / total) if total > 0 else (out[k][1], out[k][2])
                out[k] = (total, cx, cy, [*out[k][3], *members])
                changed.add(j)
                continue
        at[i] = len(out)
        out.append((w, x, y, list(members)))
    return out


def split_k(points: list[tuple[float, float, float]], k: int, rounds: int = KMEANS_ROUNDS) -> list[int]:
    """Weighted k-means of (x, y, w), started from the heaviest point and then farthest ones: deterministic labels."""
    at, w = np.array([p[:2] for p in points], float), np.array([p[2] for p in points], float)
    away = lambda c: np.hypot(at[:, 0] - c[0], at[:, 1] - c[1])
    seeds = [int(np.argmax(w))]
    near = away(at[seeds[0]])
    while len(seeds) < min(k, len(points)):
        seeds.append(int(np.argmax(near)))
        near = np.minimum(near, away(at[seeds[-1]]))
    centres = at[seeds].copy()
    labels = np.full(len(points), -1)
    for _ in range(rounds):
        new = np.argmin(np.stack([away(c) for c in centres]), axis=0)
        if (new == labels).all():
            break
        labels = new
        total = np.bincount(labels, w, len(centres))
        for c in np.flatnonzero(total > 0):
            own = labels == c
            centres[c] = (at[own] * w[own, None]).sum(axis=0) / total[c]
    return labels.tolist()


def split_capacity(points: list[tuple[float, float, float]], most: float = MAX_BRANCH_SOCKETS) -> list[int]:
    """Buckets of up to that weight: from the first point left, add the nearest to the bucket's mean until it does not fit."""
    at, w = np.array([p[:2] for p in points], float).reshape(-1, 2), np.array([p[2] for p in points], float)
    labels, free, first, bucket = np.full(len(at), -1), np.ones(len(at), bool), 0, 0
    while free.any():
        first += int(np.argmax(free[first:]))
        total, weight, n, i = np.zeros(2), 0.0, 0, first
        while True:
            labels[i], free[i] = bucket, False
            total, weight, n = total + at[i], weight + w[i], n + 1
            left = np.flatnonzero(free)
            if not len(left):
                break
            c = total / n
            i = int(left[np.argmin(np.hypot(at[left, 0] - c[0], at[left, 1] - c[1]))])
            if weight + w[i] > most:
                break
        bucket += 1
    return labels.tolist()


def attachment_groups(points: DataFrame) -> DataFrame:
    """seq, grp of (sro, seq, cluster, w, x, y): light clusters merged, heavy ones split, area by area."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq").reset_index(drop=True)
        clusters = []
        for _, g in pdf.groupby("cluster", sort=True):
            total = float(g.w.sum())
            clusters.append((total, float((g.x * g.w).sum() / total), float((g.y * g.w).sum() / total), g.index.tolist()))
        labels, n = [0] * len(pdf), 0
        for total, _, _, members in merge_small(clusters):
            if total > MAX_SOCKETS:
                k = max(2, math.ceil(total / MAX_SOCKETS))
                own = split_k([(float(pdf.x[i]), float(pdf.y[i]), float(pdf.w[i])) for i in members], k)
            else:
                own = [0] * len(members)
            names = {c: n + j for j, c in enumerate(sorted(set(own)))}
            for i, c in zip(members, own, strict=True):
                labels[i] = names[c]
            n += len(names)
        return pd.DataFrame({"sro": pdf.sro, "seq": pdf.seq, "grp": labels})

    return points.select("sro", "seq", "cluster", "w", "x", "y").groupBy("sro").applyInPandas(run, "sro string, seq long, grp int")


def branching_buckets(points: DataFrame) -> DataFrame:
    """sro, cluster, seq, bucket of (sro, cluster, seq, w, x, y): each cluster cut into buckets of at most ten sockets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq").reset_index(drop=True)
        labels = split_capacity(list(zip(pdf.x.astype(float), pdf.y.astype(float), pdf.w.astype(float), strict=True)))
        return pd.DataFrame({"sro": pdf.sro, "cluster": pdf.cluster, "seq": pdf.seq, "bucket": labels})

    return points.select("sro", "cluster", "seq", "w", "x", "y").groupBy("sro", "cluster").applyInPandas(run, "sro string, cluster long, seq long, bucket int")


def hulls(points: DataFrame, by: list[str]) -> DataFrame:
    """Convex hull vertices (counter-clockwise) of each group of three points or more; of fewer the points."""

    def half(ps: Iterator[tuple[float, float]]) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ps = sorted(set(zip(pdf.x.astype(float), pdf.y.astype(float), strict=True)))
        ring = half(ps)[:-1] + half(reversed(ps))[:-1] if len(ps) > 2 else ps
        return pd.DataFrame({**{b: [k] for b, k in zip(by, key, strict=True)}, "n": [len(ring)], "hull": [[{"x": x, "y": y} for x, y in ring]]})

    kinds = ", ".join(f"{b} {points.schema[b].dataType.simpleString()}" for b in by)
    return points.select(*by, "x", "y").groupBy(*by).applyInPandas(run, f"{kinds}, n int, hull array<struct<x:double,y:double>>")
