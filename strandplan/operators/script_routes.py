"""Routes of a project over the road network: from each attachment point to the ends in its zone, with a verdict of each.

Inputs are layers of a project: points of attachment, zones and obstacles (boxes), ends, and directed road pieces.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom
from ..graphs import checkpointed, connected_components
from . import spatial

SNAP = 50.0
BOX = ("bx0", "by0", "bx1", "by1")


def _node(x: str, y: str):
    return F.xxhash64(geom.key6(x), geom.key6(y))


def zone_pairs(points: DataFrame, zones: DataFrame, ends: DataFrame) -> DataFrame:
    """paa_id, zone_id, paste_id: the ends inside the first zone that holds each point of attachment.

    points: paa_id, x, y.  zones: zone_id, bx0, by0, bx1, by1.  ends: paste_id, x, y.  Inside means strictly, as of a box's interior.
    """
    box = tuple(map(F.col, BOX))
    held = spatial.grid_join(points, zones, spatial.point_box("x", "y"), box, 300.0).where(geom.in_box("x", "y", *BOX, strict=True))
    own = held.groupBy("paa_id").agg(F.min(F.struct("zone_id", *BOX)).alias("z")).select("paa_id", "z.*")
    inside = spatial.grid_join(own, ends, box, spatial.point_box("x", "y"), 300.0).where(geom.in_box("x", "y", *BOX, strict=True))
    return inside.select("paa_id", "zone_id", "paste_id")


def snapped_to(points: DataFrame, key: str, nodes: DataFrame) -> DataFrame:
    """key, node: the nearest node (node, nx, ny) under 50 m away."""
    pairs = spatial.grid_join(points, nodes, spatial.point_box("x", "y", SNAP), spatial.point_box("nx", "ny"), SNAP)
    d = geom.point_distance("x", "y", "nx", "ny")
    return pairs.where(d < SNAP).groupBy(key).agg(F.min(F.struct(d.alias("d"), "node")).alias("m")).select(key, F.col("m.node").alias("node"))


def search(out: Mapping[int, list[tuple[int, float]]], start: int, goals: set[int]) -> dict[int, int | None]:
    """node: the node before it, of the nodes no further from the start than the last goal that can be reached; what lies beyond it is not looked at."""
    before: dict[int, int | None] = {}
    heap, sought = [(0.0, start, None)], set(goals)
    while heap and sought:
        cost, node, prev = heapq.heappop(heap)
        if node in before:
            continue
        before[node] = prev
        sought.discard(node)
        for b, w in out[node]:
            if b not in before:
                heapq.heappush(heap, (cost + w, b, node))
    return before


def shortest(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """start, goal, nodes: the nodes of the shortest way over directed edges (a, b, length, component) for pairs (start, goal, component).

    Components run in parallel, each in one task, as its graph has to be in memory; a pair without a way is left out.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = defaultdict(list)
        for a, b, w in zip(left.a, left.b, left.length, strict=True) if len(right) else ():
            out[a].append((b, w))
        rows = []
        for start, own in right.groupby("start", sort=True):
            before = search(out, start, set(own.goal))
            for goal in sorted(set(own.goal)):
                if goal in before:
                    way = [goal]
                    while before[way[-1]] is not None:
                        way.append(before[way[-1]])
                    rows.append((start, goal, way[::-1]))
        return pd.DataFrame(rows, columns=["start", "goal", "nodes"])

    asked = edges.join(pairs.select("component").distinct(), "component", "left_semi")
    return asked.groupBy("component").cogroup(pairs.groupBy("component")).applyInPandas(run, "start long, goal long, nodes array<long>")


def deliverable(points: DataFrame, zones: DataFrame, ends: DataFrame, roads: DataFrame, obstacles: DataFrame) -> DataFrame:
    """paa_id, zone_id, paste_id, status, n_nodes, infra_existante of every pair of zone_pairs.

    roads: directed pieces ax, ay, bx, by.  A way is AUTO if there is one and no obstacle (a box) touches it; else MANUAL_REVIEW.
    """
    edges = checkpointed(roads.select(_node("ax", "ay").alias("a"), _node("bx", "by").alias("b"), geom.point_distance("ax", "ay", "bx", "by").alias("length"), "ax", "ay", F.col("bx").alias("ex"), F.col("by").alias("ey")))
    nodes = checkpointed(edges.select(F.col("a").alias("node"), F.col("ax").alias("nx"), F.col("ay").alias("ny")).union(edges.select("b", "ex", "ey")).dropDuplicates(["node"]))
    of = checkpointed(connected_components(edges))
    pairs = checkpointed(zone_pairs(points, zones, ends))
    start = snapped_to(points, "paa_id", nodes).withColumnRenamed("node", "start")
    goal = snapped_to(ends, "paste_id", nodes).withColumnRenamed("node", "goal")
    placed = checkpointed(pairs.join(start, "paa_id", "left").join(goal, "paste_id", "left"))
    ask = placed.select("start", "goal").dropna().distinct().join(of.toDF("start", "component"), "start").join(of.toDF("goal", "goal_component"), "goal").where("component = goal_component")
    ways = checkpointed(shortest(edges.join(of.toDF("a", "component"), "a").select("a", "b", "length", "component"), ask.select("start", "goal", "component")))
    steps = ways.select("start", "goal", F.explode(F.arrays_zip(F.slice("nodes", 1, F.size("nodes") - 1).alias("p"), F.slice("nodes", 2, F.size("nodes") - 1).alias("q"))).alias("s")).select("start", "goal", "s.p", "s.q")
    drawn = steps.join(nodes.toDF("p", "x1", "y1"), "p").join(nodes.toDF("q", "x2", "y2"), "q").select("start", "goal", "x1", "y1", "x2", "y2")
    shape = ("x1", "y1", "x2", "y2")
    met = spatial.grid_join(drawn, obstacles, spatial.segment_box(*shape), tuple(map(F.col, BOX)), 150.0)
    t_in, t_out = geom.box_interval(*shape, *BOX)
    hit = met.where(t_in <= t_out).select("start", "goal").distinct().withColumn("hit", F.lit(True))
    found = placed.join(ways.select("start", "goal", F.size("nodes").alias("n_nodes")), ["start", "goal"], "left").join(hit, ["start", "goal"], "left")
    exists = F.col("n_nodes").isNotNull()
    status = F.when(exists & F.col("hit").isNull(), "AUTO").otherwise("MANUAL_REVIEW")
    return found.select("paa_id", "zone_id", "paste_id", status.alias("status"), F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"), exists.alias("infra_existante"))
