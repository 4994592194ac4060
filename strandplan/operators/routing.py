"""Graph building and routing: edge tables, degrees, shortest paths, path verdicts, budgets, mutualisation."""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..graphs import checkpointed

# Metres and ratios of the routing rules.
ROAD_PER_EDGE, ROAD_PER_AREA, ROAD_PER_PATH, ROAD_RATIO, ROAD_RATIO_FROM = 50.0, 300.0, 800.0, 0.80, 300.0
PENALTY = 1e9
VISIBLE_ANCHOR, LOGICAL_ANCHOR = 3.0, 150.0


def undirected(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """With the ends in order."""
    return edges.withColumns({u: F.least(u, v), v: F.greatest(u, v)})


def simple_graph(edges: DataFrame, key: list[str], order: str, keep: list[str]) -> DataFrame:
    """Edges between the same ends updated in place by later ones: the last value that is not null of each attribute."""
    return edges.groupBy(*key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in keep))


def shortest_parallel(edges: DataFrame, key: list[str], length: str, order: str, keep: list[str]) -> DataFrame:
    """The shortest of parallel edges, without loops."""
    best = F.min(F.struct(length, order, *keep)).alias("m")
    return edges.where("u <> v").groupBy(*key).agg(best).select(*key, F.col(f"m.{length}").alias(length), *(F.col(f"m.{c}").alias(c) for c in keep))


def degrees(edges: DataFrame, on: list[str] | None = None, u: str = "u", v: str = "v") -> DataFrame:
    keys = list(on or [])
    ends = edges.select(*keys, F.col(u).alias("node")).unionAll(edges.select(*keys, F.col(v).alias("node")))
    return ends.groupBy(*keys, "node").agg(F.count("*").alias("degree"))


def deliverable(covered: Column) -> Column:
    """An edge can be delivered unless it is marked so, or is a road piece too long or outside the strict area."""
    road = F.col("type") == "ign_route"
    return ~F.coalesce(F.col("virtual"), F.lit(False)) & F.coalesce(F.col("deliverable"), F.lit(True)) & (~road | ((F.col("length") <= ROAD_PER_EDGE) & F.coalesce(covered, F.lit(False))))


def routing_weights(base: Column, can: Column) -> tuple[Column, Column]:
    """(weight of the second pass, of the first, which only wants what exists)."""
    return base + F.when(can, 0.0).otherwise(PENALTY), base + F.when(can & (F.col("type") == "infra"), 0.0).otherwise(PENALTY)


def anchor_kind(d: Column, covered: Column) -> Column:
    return F.when((d <= VISIBLE_ANCHOR) & covered, "visible").when(d <= LOGICAL_ANCHOR, "logical").otherwise("missing")


def dijkstra(edges: DataFrame, sources: DataFrame, group: str, weight: str) -> DataFrame:
    """group, source, node, cost, hops, prev: least cost from every source of a group over its undirected edges.

    Groups run in parallel, each within one task, as its graph has to be in memory; ties go to fewer hops, then the smaller node.
    """

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        near = defaultdict(list)
        for u, v, w in zip(left.u, left.v, left.w, strict=True):
            near[u].append((v, w))
            near[v].append((u, w))
        rows = []
        for s in sorted(set(right.source)):
            done: set = set()
            heap = [(0, 0, s, s)]
            while heap:
                cost, hops, node, prev = heapq.heappop(heap)
                if node in done:
                    continue
                done.add(node)
                rows.append((key[0], s, node, cost, hops, prev))
                for other, w in near[node]:
                    if other not in done:
                        heapq.heappush(heap, (cost + w, hops + 1, other, node))
        return pd.DataFrame(rows, columns=["grp", "source", "node", "cost", "hops", "prev"])

    e = edges.select(F.col(group).alias("grp"), "u", "v", F.col(weight).alias("w"))
    s = sources.select(F.col(group).alias("grp"), "source")
    kind, number = s.schema["source"].dataType.simpleString(), e.schema["w"].dataType.simpleString()
    schema = f"grp {e.schema['grp'].dataType.simpleString()}, source {kind}, node {kind}, cost {number}, hops int, prev {kind}"
    return e.groupBy("grp").cogroup(s.groupBy("grp")).applyInPandas(run, schema).withColumnRenamed("grp", group)


def relaxed(edges: DataFrame, sources: DataFrame, group: str, weight: str) -> DataFrame:
    """group, source, node, cost: the same least costs by joins, for graphs that no single task could hold.

    As many rounds as the longest cheapest path has edges, and one; weights may not be negative, as they would never end.
    """
    if not edges.where(F.col(weight) < 0).isEmpty():
        raise ValueError(f"negative {weight}")
    both = edges.select(F.col(group), F.col("u").alias("node"), F.col("v").alias("to"), F.col(weight).alias("w"))
    both = both.unionByName(edges.select(F.col(group), F.col("v").alias("node"), F.col("u").alias("to"), F.col(weight).alias("w")))
    zero = F.lit(0).cast(edges.schema[weight].dataType)
    now = checkpointed(sources.select(group, "source", F.col("source").alias("node"), zero.alias("cost")).distinct())
    front = now
    while True:
        step = front.join(both, [group, "node"]).groupBy(group, "source", F.col("to").alias("node")).agg(F.min(F.col("cost") + F.col("w")).alias("new"))
        front = checkpointed(step.join(now, [group, "source", "node"], "left").where("cost is null or new < cost").select(group, "source", "node", F.col("new").alias("cost")))
        if front.isEmpty():
            break
        now = checkpointed(now.unionByName(front).groupBy(group, "source", "node").agg(F.min("cost").alias("cost")))
    return now


def path_verdicts(path_edges: DataFrame, path: str, order: str) -> DataFrame:
    """Of each path: whether all its edges can be delivered, and the reason of the first that can't."""
    bad = F.col("defect") != ""
    return path_edges.groupBy(path).agg(F.bool_and(~bad).alias("accepted"), F.min_by(F.when(bad, F.col("defect")), F.when(bad, F.col(order))).alias("reason"), F.sum("metres").alias("metres"))


def budgeted(paths: DataFrame, group: str, order: str, metres: str, most: float) -> DataFrame:
    """group, order, accepted: paths taken in order while the accepted ones' metres stay within the budget of their group.

    A rejected path uses nothing, so this is a fold, not a running sum: one pass over a group's paths, in one task.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        used, out = 0.0, []
        for m in pdf["m"].tolist():
            out.append(used + m <= most)
            used += m if out[-1] else 0.0
        return pd.DataFrame({"g": pdf["g"], "k": pdf["k"], "accepted": out})

    kinds = [paths.schema[c].dataType.simpleString() for c in (group, order)]
    folded = paths.select(F.col(group).alias("g"), F.col(order).alias("k"), F.col(metres).cast("double").alias("m")).groupBy("g").applyInPandas(fold, f"g {kinds[0]}, k {kinds[1]}, accepted boolean")
    return folded.select(F.col("g").alias(group), F.col("k").alias(order), "accepted")


def path_budget_ok(road: Column, total: Column) -> Column:
    return ~((road > ROAD_PER_PATH) | ((total >= ROAD_RATIO_FROM) & (road / total > ROAD_RATIO)))


def committed(kind: str = "src") -> tuple[Column, Column, Column]:
    """(statut, mode_pose, infra_type) of a committed edge: road pieces and planned works become works to create."""
    road, planned = F.col(kind) == "ign", F.col(kind) == "gc_neuf"
    return (
        F.when(road | planned, F.lit(None)).otherwise(F.coalesce("statut", F.lit(""))),
        F.when(road | planned, F.lit("C0")).otherwise(F.coalesce("mode_pose", F.lit(""))),
        F.when(road | planned, F.lit("gc_neuf")).otherwise(F.col(kind)),
    )


def purge_paths(rows: DataFrame, key: str, path: str, bad: Column) -> DataFrame:
    """Rows (one for each edge and path) without bad edges, without the paths that had one, anywhere."""
    broken = rows.where(bad).select(path).distinct()
    return rows.where(~bad).join(broken, path, "left_anti")
