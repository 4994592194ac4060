"""The routed delivery: graph of existing lines and roads, two-pass routes from attachment to branching points, budgets, purge.

All areas run together; only the shortest paths of one area are found within one task.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom
from ..graphs import checkpointed, connected_components
from . import attributes as at
from . import intervals, routing, spatial, topology

WELD, ANCHOR = 2.0, 50.0


def node_of(x: str, y: str):
    return F.xxhash64(geom.key6(x), geom.key6(y))


def network(infra: DataFrame, roads: DataFrame, public: DataFrame, gate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes): nodes are sro, node, x, y of every line end under its welded node; edges are eid, sro, u, v, type, src, statut, mode_pose, length, can, x1, y1, x2, y2: nodes within 2 m welded, the shorter of parallel edges.

    public: boxes (kind, bx0, by0, bx1, by1) that decide the strict public ground, which a road piece must lie on to be delivered; not so
    without the gate, which is lenient routing.
    """
    shape = ["x1", "y1", "x2", "y2"]
    lines = infra.select("sro", "seq", F.lit("infra").alias("type"), "src", "statut", "mode_pose", *shape)
    ways = roads.select("sro", "seq", F.lit("ign_route").alias("type"), F.lit("ign").alias("src"), F.lit(None).cast("string").alias("statut"), F.lit(None).cast("string").alias("mode_pose"), *shape)
    raw = checkpointed(lines.unionByName(ways).withColumns({"a": node_of("x1", "y1"), "b": node_of("x2", "y2"), "length": geom.length()}))
    nodes = raw.select("sro", F.col("a").alias("node"), F.col("x1").alias("x"), F.col("y1").alias("y")).union(raw.select("sro", "b", "x2", "y2")).dropDuplicates(["sro", "node"])
    welds = connected_components(spatial.close_pairs(nodes, "node", WELD, ["sro"]))
    moved = raw
    for end, name in (("a", "u"), ("b", "v")):
        moved = moved.join(welds.select(F.col("node").alias(end), F.col("component").alias(name)), end, "left").withColumn(name, F.coalesce(name, end))
    keep = ["type", "src", "statut", "mode_pose", *shape]
    rank = F.when(F.col("type") == "infra", F.col("seq")).otherwise(F.col("seq") + (1 << 40))
    edges = routing.shortest_parallel(routing.undirected(moved.withColumn("rank", rank)), ["sro", "u", "v"], "length", "rank", keep)
    places = nodes.join(welds, "node", "left").select("sro", F.coalesce("component", "node").alias("node"), "x", "y")
    edges = checkpointed(edges.withColumn("eid", F.xxhash64("sro", "u", "v")))
    ways = edges.where("type = 'ign_route'").select("eid", *shape)
    cover = intervals.public_cover(ways, public, ["eid"], cell=150.0)
    marked = edges.join(cover, "eid", "left").withColumns({"virtual": F.lit(False), "deliverable": F.lit(True)})
    return checkpointed(marked.withColumn("can", routing.deliverable(F.col("covered") if gate else F.lit(True))).drop("covered", "virtual", "deliverable")), checkpointed(places)


def anchored(points: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """key, sro, node: the nearest node of the area's network under 50 m."""
    ends = nodes.select("sro", "node", F.col("x").alias("nx"), F.col("y").alias("ny"))
    pairs = spatial.grid_join(points.select("sro", key, "x", "y"), ends, spatial.point_box("x", "y", ANCHOR), spatial.point_box("nx", "ny"), ANCHOR, ["sro"])
    hit = pairs.select("sro", key, F.struct(geom.point_distance("x", "y", "nx", "ny").alias("d"), "node").alias("h")).where(F.col("h.d") < ANCHOR)
    return hit.groupBy("sro", key).agg(F.min("h").alias("m")).select("sro", key, F.col("m.node").alias("node"))


MICRO_BRIDGE = 3.0


def micro_bridges(edges: DataFrame, pairs: DataFrame, places: DataFrame, public: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges with bridges, flags): what joins pairs (sro, pa_id, pb_id, pa_node, pb_node) whose nodes lie in different components.

    Nodes up to 3 m apart get a straight edge, works to create; it can be delivered if it lies on public ground, and else only helps to find a
    route.  Those further apart get none, but a flag for review by hand.  places: node, x, y (any of a node's).
    """
    of = connected_components(edges, "u", "v")
    at = places.groupBy("node").agg(F.min(F.struct("x", "y")).alias("at"))
    held = pairs
    for end, name in (("pa_node", "a"), ("pb_node", "b")):
        held = held.join(of.select(F.col("node").alias(end), F.col("component").alias(f"c{name}")), end, "left").join(at.select(F.col("node").alias(end), F.col("at.x").alias(f"{name}x"), F.col("at.y").alias(f"{name}y")), end)
    apart = checkpointed(held.where("coalesce(ca, pa_node) <> coalesce(cb, pb_node)").withColumn("d", geom.point_distance("ax", "ay", "bx", "by")))
    near = apart.where(F.col("d") <= MICRO_BRIDGE)
    made = near.select("sro", F.least("pa_node", "pb_node").alias("u"), F.greatest("pa_node", "pb_node").alias("v"), F.lit("gc_neuf").alias("type"), F.lit("gc_neuf").alias("src"), F.lit(None).cast("string").alias("statut"), F.lit("C0").alias("mode_pose"), F.col("d").alias("length"), *(F.col(c).alias(n) for c, n in (("ax", "x1"), ("ay", "y1"), ("bx", "x2"), ("by", "y2"))))
    made = checkpointed(made.dropDuplicates(["sro", "u", "v"]).withColumn("eid", F.xxhash64("sro", "u", "v")))
    cover = intervals.public_cover(made.select("eid", "x1", "y1", "x2", "y2"), public, ["eid"], cell=150.0)
    bridges = checkpointed(made.join(cover, "eid").withColumn("can", F.col("covered")).drop("covered"))
    laid = near.select("sro", "pa_id", "pb_id", "d", F.xxhash64("sro", F.least("pa_node", "pb_node"), F.greatest("pa_node", "pb_node")).alias("eid")).join(bridges.select("eid", "can"), "eid")
    flags = laid.select("sro", "pa_id", "pb_id", "d", F.when(F.col("can"), "MICRO_BRIDGE_CREATED").otherwise("MICRO_BRIDGE_CREATED_VIRTUAL").alias("flag"))
    review = apart.where(F.col("d") > MICRO_BRIDGE).select("sro", "pa_id", "pb_id", "d", F.lit("COMPONENT_BRIDGE_REQUIRED_MANUAL_REVIEW").alias("flag"))
    return edges.unionByName(bridges.select(*edges.columns)), flags.unionByName(review)


def routes(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """sro, pa_id, pb_id, pass, pos, eid: the edges of each pair's path; eid is null for a pair without one.

    Existing lines that can be delivered come first; only what they do not reach goes over all edges at their weights, where an edge
    that can't be delivered costs a penalty.
    """

    def tree(near: dict, start: int) -> dict:
        done: dict = {}
        heap = [(0.0, 0, start, None, None)]
        while heap:
            cost, hops, node, prev, eid = heapq.heappop(heap)
            if node in done:
                continue
            done[node] = (prev, eid)
            for other, w, e in near[node]:
                if other not in done:
                    heapq.heappush(heap, (cost + w, hops + 1, other, node, e))
        return done

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        first, second = defaultdict(list), defaultdict(list)
        for u, v, eid, length, kind, can in zip(left.u, left.v, left.eid, left.length, left.type, left.can, strict=True):
            w = length * at.ROUTE_FACTORS[kind] + (0.0 if can else routing.PENALTY)
            for a, b in ((u, v), (v, u)):
                second[a].append((b, w, eid))
                if can and kind == "infra":
                    first[a].append((b, length, eid))
        rows = []
        for start, own in right.groupby("pa_node", sort=True):
            trees: dict[int, dict] = {}
            for r in own.sort_values("pb_id").itertuples():
                for k, near in ((1, first), (2, second)):
                    if k not in trees:
                        trees[k] = tree(near, start)
                    if r.pb_node in trees[k]:
                        node, back = r.pb_node, []
                        while trees[k][node][0] is not None:
                            node, eid = trees[k][node]
                            back.append(eid)
                        rows += [(r.sro, r.pa_id, r.pb_id, k, i, e) for i, e in enumerate(reversed(back))]
                        break
                else:
                    rows.append((r.sro, r.pa_id, r.pb_id, 0, 0, None))
        out = pd.DataFrame(rows, columns=["sro", "pa_id", "pb_id", "pass", "pos", "eid"])
        out["eid"] = pd.array(out["eid"], dtype="Int64")
        return out

    e = edges.select("sro", "u", "v", "eid", "length", "type", "can")
    return e.groupBy("sro").cogroup(pairs.select("sro", "pa_id", "pb_id", "pa_node", "pb_node").groupBy("sro")).applyInPandas(run, "sro string, pa_id string, pb_id string, pass int, pos int, eid long")


def delivered(infra: DataFrame, roads: DataFrame, public: DataFrame, pa: DataFrame, pb: DataFrame, gate: bool = True) -> dict[str, DataFrame]:
    """rows: the delivered edges with the paths that use them; outcomes: of every branching point; bridges: flags of micro_bridges.

    pa: sro, pa_id, x, y.  pb: sro, pb_id, pa_id, x, y.  Paths are taken in the order of pa_id, pb_id; each has to be
    deliverable throughout, within the path's budget of road metres, and within what is left of its area's.
    """
    edges, nodes = network(infra, roads, public, gate)
    pas = anchored(pa, nodes, "pa_id").select("sro", "pa_id", F.col("node").alias("pa_node"))
    pbs = anchored(pb, nodes, "pb_id").select("sro", "pb_id", F.col("node").alias("pb_node"))
    pairs = checkpointed(pb.select("sro", "pb_id", "pa_id").join(pbs, ["sro", "pb_id"]).join(pas, ["sro", "pa_id"]))
    edges, bridges = micro_bridges(edges, pairs, nodes, public)
    edges = checkpointed(edges)
    steps = checkpointed(routes(edges, pairs))
    walked = steps.where("eid is not null").join(edges.select("eid", "src", "length", "can"), "eid")
    path = walked.groupBy("sro", "pa_id", "pb_id").agg(F.bool_and("can").alias("can"), F.sum("length").alias("total"), F.coalesce(F.sum(F.when(F.col("src") == "ign", F.col("length"))), F.lit(0.0)).alias("m"))
    order = F.row_number().over(Window.partitionBy("sro").orderBy("pa_id", "pb_id")).cast("long")
    path = checkpointed(path.where("can").withColumn("k", order))
    budget = routing.budgeted(path, "sro", "k", "m", routing.ROAD_PER_AREA)
    taken = path.join(budget, ["sro", "k"]).withColumn("fits", routing.path_budget_ok(F.col("m"), F.col("total")))
    taken = checkpointed(taken.select("sro", "pa_id", "pb_id", "accepted", "fits"))
    used = steps.where("eid is not null").join(taken.where("accepted and fits").select("sro", "pa_id", "pb_id"), ["sro", "pa_id", "pb_id"])
    tagged = used.withColumn("path", F.col("pb_id")).join(edges, ["sro", "eid"])
    anchors = pairs.select(F.col("pb_id").alias("path"), "pa_node", "pb_node")
    left = topology.purged(tagged.select(F.col("u").alias("a"), F.col("v").alias("b"), "path", "eid"), anchors)
    statut, pose, kind = routing.committed()
    paths = F.array_join(F.array_sort(F.collect_set("path")), "|").alias("_used_by_paths")
    rows = edges.join(left.groupBy("eid").agg(paths), "eid").select("sro", "eid", statut.alias("statut"), pose.alias("mode_pose"), kind.alias("infra_type"), "src", F.col("length").alias("length_m"), "_used_by_paths", "x1", "y1", "x2", "y2")
    kept = left.select(F.col("path").alias("pb_id")).distinct().withColumn("kept", F.lit(True))
    reach = steps.groupBy("pb_id").agg(F.max("pass").alias("pass"), F.count("eid").alias("n_edges"))
    outcome = (
        F.when(F.col("pass").isNull(), "missing_anchor")
        .when(F.col("pass") == 0, "unreachable_after_pass2")
        .when(F.col("kept"), "delivered")
        .when(F.col("accepted").isNull(), "non_deliverable_no_alternative")
        .when(~F.col("accepted"), "sro_ign_cap_exceeded")
        .when(~F.col("fits"), "path_ign_budget_exceeded")
        .otherwise("path_broken_after_postprocess")
    )
    outcomes = pb.select("sro", "pb_id").join(reach, "pb_id", "left").join(taken.select("pb_id", "accepted", "fits"), "pb_id", "left").join(kept, "pb_id", "left")
    return {"rows": rows, "outcomes": outcomes.select("sro", "pb_id", outcome.alias("outcome")), "bridges": bridges}
