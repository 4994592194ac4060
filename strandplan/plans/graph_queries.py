"""Queries on graphs, clusters and routed chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom
from ..functions.layers import layer, oracle
from ..graphs import connected_components
from ..operators import attributes as at
from ..operators import clusters, placement, progress, routing, topology
from .attribute_queries import reusable

Q: dict = {}
S: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def _reach(radius: str) -> dict[str, str]:
    return {
        "near": f"select a.seq as a, b.seq as b from bal a join bal b on a.sro = b.sro and a.seq <> b.seq and sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {radius}",
        "reach": "select seq as s, seq as o from bal union select r.s, n.b from reach r join near n on n.a = r.o",
        "labels": "select s as seq, min(o) as cluster from reach group by s",
    }


@query(oracle("bal", "select seq, cluster from labels", **_reach("100")))
def c1_clusters_100m(spark, sf):
    return clusters.distance_clusters(layer(spark, sf, "bal").select("seq", "sro", "x", "y"), "seq", 100.0, ["sro"]).select("seq", "cluster")


_MEAN = "select cluster, floor(avg(x) * 1e6 + 5e-1) / 1e6 as wx, floor(avg(y) * 1e6 + 5e-1) / 1e6 as wy from labels join bal using (seq) group by cluster"


@query(oracle("bal", "select seq, cluster, wx, wy from labels join centre using (cluster)", **_reach("40"), centre=_MEAN))
def r3_weld(spark, sf):
    return clusters.welded(layer(spark, sf, "bal").select("seq", "sro", "x", "y"), "seq", 40.0, ["sro"]).select("seq", "cluster", "wx", "wy")


@query(oracle("bal", "select cluster, count(*) as n, max(wx) as wx, max(wy) as wy from labels join centre using (cluster) group by cluster having count(*) > 1", **_reach("40"), centre=_MEAN))
def c5_endpoint_snap(spark, sf):
    w = clusters.welded(layer(spark, sf, "bal").select("seq", "sro", "x", "y"), "seq", 40.0, ["sro"])
    return w.groupBy("cluster").agg(F.count("*").alias("n"), F.max("wx").alias("wx"), F.max("wy").alias("wy")).where("n > 1")


@query(oracle("bal", "select cluster, floor(avg(x) * 1e6 + 5e-1) / 1e6 as cx, floor(avg(y) * 1e6 + 5e-1) / 1e6 as cy, count(*) as n from labels join bal using (seq) group by cluster", **_reach("100")))
def a7_cluster_centroid(spark, sf):
    found = clusters.distance_clusters(layer(spark, sf, "bal").select("seq", "sro", "x", "y"), "seq", 100.0, ["sro"])
    return found.groupBy("cluster").agg(geom.key6(F.avg("x")).alias("cx"), geom.key6(F.avg("y")).alias("cy"), F.count("*").alias("n"))


@query(oracle("bal", "select n.a, n.b from near60 n join labels x on x.seq = n.a join labels y on y.seq = n.b where n.a < n.b and x.cluster <> y.cluster", near60="select a.seq as a, b.seq as b from bal a join bal b on a.sro = b.sro and sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 60", **_reach("20")))
def t5_micro_gaps(spark, sf):
    found = clusters.distance_clusters(layer(spark, sf, "bal").select("seq", "sro", "x", "y"), "seq", 20.0, ["sro"])
    return topology.micro_gaps(found, "seq", "cluster", 60.0, ["sro"])


@query()
def a17_zone_hulls(spark, sf):
    return clusters.hulls(layer(spark, sf, "bal"), ["sro"]).select("sro", "n", F.to_json("hull").alias("hull"))


@query()
def p1_attachment_points(spark, sf):
    return placement.attachment_points(layer(spark, sf, "bal"), layer(spark, sf, "zapa"), layer(spark, sf, "infra"), layer(spark, sf, "parcelle"))


@query()
def p2_branching_points(spark, sf):
    return placement.branching_points(layer(spark, sf, "bal"), layer(spark, sf, "pa"), layer(spark, sf, "zapa"), reusable(spark, sf))


_NET = "select sro_no, least(u, v) as u, greatest(u, v) as v, metres, type, seq from net"


def net(spark, sf):
    return routing.undirected(layer(spark, sf, "net"))


@query(oracle("net", "select sro_no, u, v, arg_max(type, seq) as type, arg_max(metres, seq) as metres from e group by sro_no, u, v", e=_NET))
def r2_simple_graph(spark, sf):
    return routing.simple_graph(net(spark, sf), ["sro_no", "u", "v"], "seq", ["type", "metres"])


@query(oracle("net", "select sro_no, u, v, m.metres as metres, m.type as type from (select sro_no, u, v, min({'metres': metres, 'seq': seq, 'type': type}) as m from e group by sro_no, u, v)", e=_NET))
def r3_shortest_parallel(spark, sf):
    return routing.shortest_parallel(net(spark, sf), ["sro_no", "u", "v"], "metres", "seq", ["type"])


@query(oracle("net", "select sro_no, node from (select sro_no, u as node from e2 union all select sro_no, v from e2) group by 1, 2 having count(*) = 1", e2=f"select * from ({_NET}) where seq % 3 = 0"))
def r5_dead_ends(spark, sf):
    return routing.degrees(net(spark, sf).where("seq % 3 = 0"), ["sro_no"]).where("degree = 1").select("sro_no", "node")


@query(oracle("net", "select sro_no, count(distinct c) as n_components, count(*) as n_nodes from (select s, any_value(s // 100) as sro_no, min(o) as c from reach group by s) group by sro_no",
 e2=f"select sro_no * 100 + u as a, sro_no * 100 + v as b from ({_NET}) where seq % 3 = 0", dirs="select a, b from e2 union select b, a from e2", reach="select a as s, a as o from dirs union select r.s, n.b from reach r join dirs n on n.a = r.o"))
def r12_component_count(spark, sf):
    e = net(spark, sf).where("seq % 3 = 0").select((F.col("sro_no") * 100 + F.col("u")).alias("a"), (F.col("sro_no") * 100 + F.col("v")).alias("b"))
    return connected_components(e).groupBy(F.floor(F.col("node") / 100).alias("sro_no")).agg(F.countDistinct("component").alias("n_components"), F.count("*").alias("n_nodes"))


_SSSP = dict(
    e=f"select sro_no, u, v, min(metres) as w from ({_NET}) group by 1, 2, 3",
    dirs="select sro_no, u as a, v as b, w from e union all select sro_no, v, u, w from e",
)
_WALK = "select distinct sro_no, 0::bigint as node, 0::bigint as cost, 0 as hop from e union select d.sro_no, x.b, min(d.cost + x.w), d.hop + 1 from walk d join dirs x on x.sro_no = d.sro_no and x.a = d.node where d.hop < 22 group by d.sro_no, x.b, d.hop + 1"


def sources(spark, sf):
    return net(spark, sf).select("sro_no", F.lit(0).cast("bigint").alias("source")).distinct()


@query(oracle("net", "select sro_no, node, min(cost) as cost from walk where exists (select 1 from dirs b where b.sro_no = walk.sro_no and b.a = 0) or node = 0 group by sro_no, node", **_SSSP, walk=_WALK))
def r13_sssp_cost(spark, sf):
    return routing.dijkstra(net(spark, sf), sources(spark, sf), "sro_no", "metres").select("sro_no", "node", "cost")


@query(oracle("net", "select sro_no, node, min(cost) as cost from walk group by sro_no, node", **_SSSP, walk=_WALK))
def r13_sssp_by_joins(spark, sf):
    return routing.relaxed(net(spark, sf), sources(spark, sf), "sro_no", "metres").select("sro_no", "node", "cost")


_EXISTING = f"select sro_no, u, v, min(metres) as w from ({_NET}) where type = 'infra' group by 1, 2, 3"
_ANYWAY = f"select sro_no, u, v, min(metres * case type when 'gc_neuf' then 10 when 'ign_route' then 30 else 1 end) as w from ({_NET}) group by 1, 2, 3"


def _walk(n: str) -> str:
    return f"select distinct sro_no, 0::bigint as node, 0::bigint as cost, 0 as hop from net union select d.sro_no, x.b, min(d.cost + x.w), d.hop + 1 from {n} d join (select sro_no, u as a, v as b, w from {n}_e union all select sro_no, v, u, w from {n}_e) x on x.sro_no = d.sro_no and x.a = d.node where d.hop < 22 group by d.sro_no, x.b, d.hop + 1"


@query(oracle("net", "select a.sro_no, a.node, case when p.cost is not null then 'existing' else 'mixed' end as pass, coalesce(p.cost, a.cost) as cost from (select sro_no, node, min(cost) as cost from w2 group by 1, 2) a left join (select sro_no, node, min(cost) as cost from w1 group by 1, 2) p on p.sro_no = a.sro_no and p.node = a.node",
 w1_e=_EXISTING, w2_e=_ANYWAY, w1=_walk("w1"), w2=_walk("w2")))
def r14_two_passes(spark, sf):
    """Existing lines first; only what they do not reach goes over all edges at their weights."""
    e = net(spark, sf)
    first = routing.dijkstra(e.where("type = 'infra'"), sources(spark, sf), "sro_no", "metres").select("sro_no", "node", "cost", F.lit("existing").alias("pass"))
    second = routing.dijkstra(e.withColumn("w", at.route_weight("metres").cast("bigint")), sources(spark, sf), "sro_no", "w").select("sro_no", "node", "cost")
    return first.unionByName(second.join(first.select("sro_no", "node"), ["sro_no", "node"], "left_anti").withColumn("pass", F.lit("mixed")))


@query(oracle("chain", "select pb, bool_and(defect = '') as accepted, arg_min(defect, seq) filter (where defect <> '') as reason, sum(metres)::bigint as metres from chain group by pb"))
def r16_path_verdict(spark, sf):
    return routing.path_verdicts(layer(spark, sf, "chain"), "pb", "seq")


_PATHS = "select sro_no, pb, coalesce(sum(metres) filter (where src = 'ign'), 0)::bigint as m, sum(metres)::bigint as total from chain group by sro_no, pb"


def paths(spark, sf):
    ign = F.coalesce(F.sum(F.when(F.col("src") == "ign", F.col("metres"))), F.lit(0))
    return layer(spark, sf, "chain").groupBy("sro_no", "pb").agg(ign.alias("m"), F.sum("metres").alias("total"))


@query(oracle("chain", "select sro_no, pb, ok as accepted from fold where k > 0", p=_PATHS, r="select *, row_number() over (partition by sro_no order by pb) as k from p",
 fold="select distinct sro_no, null::bigint as pb, 0::bigint as k, 0::bigint as used, false as ok from p union all select r.sro_no, r.pb, r.k, f.used + case when f.used + r.m <= 300 then r.m else 0 end, f.used + r.m <= 300 from fold f join r on r.sro_no = f.sro_no and r.k = f.k + 1"))
def r17_budget_fold(spark, sf):
    return routing.budgeted(paths(spark, sf), "sro_no", "pb", "m", routing.ROAD_PER_AREA)


@query(oracle("chain", "select sro_no, pb, not (m > 800 or total >= 300 and m / cast(total as double) > 0.8) as ok from p", p=_PATHS))
def r18_path_budget(spark, sf):
    return paths(spark, sf).select("sro_no", "pb", routing.path_budget_ok(F.col("m").cast("double"), F.col("total").cast("double")).alias("ok"))


@query(oracle("net", "select seq, metres * case type when 'gc_neuf' then 10 when 'ign_route' then 30 else 1 end + case when type = 'ign_route' and metres > 50 then 1e9 else 0e0 end as w2, metres * case type when 'gc_neuf' then 10 when 'ign_route' then 30 else 1 end + case when type = 'infra' then 0e0 else 1e9 end as w1 from net"))
def r8_weights(spark, sf):
    can = ~((F.col("type") == "ign_route") & (F.col("metres") > routing.ROAD_PER_EDGE))
    w2, w1 = routing.routing_weights(at.route_weight("metres").cast("double"), can)
    return layer(spark, sf, "net").select("seq", w2.alias("w2"), w1.alias("w1"))


@query(oracle("chain", "select seq, case when src = 'ign' then null else 'E' end as statut, case when src = 'ign' then 'C0' else '7' end as mode_pose, case when src = 'ign' then 'gc_neuf' else src end as infra_type from chain"))
def r19_commit(spark, sf):
    statut, pose, kind = routing.committed()
    return layer(spark, sf, "chain").withColumns({"statut": F.lit("E"), "mode_pose": F.lit("7")}).select("seq", statut.alias("statut"), pose.alias("mode_pose"), kind.alias("infra_type"))


@query(oracle("chain", "select seq from chain where not (src = 'ign' and node_a % 17 = 0) and pb not in (select pb from chain where src = 'ign' and node_a % 17 = 0)"))
def r21_private_path_purge(spark, sf):
    return routing.purge_paths(layer(spark, sf, "chain"), "seq", "pb", (F.col("src") == "ign") & (F.col("node_a") % 17 == 0)).select("seq")


@query(oracle("chain", "select sro_no, count(*) as n_rows, count(*) filter (where src = 'ign') as n_c0, count(*) filter (where defect = 'virtual') as n_virtual, count(*) filter (where src = 'ign' and metres > 30) as n_chords, count(distinct pb) as n_paths, sum(metres)::bigint as metres from chain group by sro_no"))
def r24_qa_counters(spark, sf):
    road = F.col("src") == "ign"
    return layer(spark, sf, "chain").groupBy("sro_no").agg(
        F.count("*").alias("n_rows"), F.count_if(road).alias("n_c0"), F.count_if(F.col("defect") == "virtual").alias("n_virtual"),
        F.count_if(road & (F.col("metres") > 30)).alias("n_chords"), F.countDistinct("pb").alias("n_paths"), F.sum("metres").alias("metres"),
    )


_ALLOWED = "('motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'unclassified', 'residential', 'service', 'living_street', 'pedestrian')"


@query(oracle("road", f"select seq, x1 as ax, y1 as ay, x2 as bx, y2 as \"by\" from road where highway is null or highway in {_ALLOWED} union all select seq, x2, y2, x1, y1 from road where oneway <> 'yes' and (highway is null or highway in {_ALLOWED})"))
def r27_road_digraph(spark, sf):
    road = layer(spark, sf, "road").where(at.road_allowed())
    names = ["seq", "ax", "ay", "bx", "by"]
    return road.select("seq", "x1", "y1", "x2", "y2").toDF(*names).unionByName(road.where("oneway <> 'yes'").select("seq", "x2", "y2", "x1", "y1").toDF(*names))


@query(oracle("net", "select n.sro_no, n.node, case when c.cost is not null and n.node % 4 <> 3 then 'AUTO' else 'MANUAL_REVIEW' end as status, c.cost is not null as infra_existante from (select distinct sro_no, u as node from e union select distinct sro_no, v from e) n left join (select sro_no, node, min(cost) as cost from w1 group by 1, 2) c on c.sro_no = n.sro_no and c.node = n.node",
 e=_NET, w1_e=_EXISTING, w1=_walk("w1")))
def r29_route_status(spark, sf):
    """Shortest route of each node over existing lines: automatic if there is one and no obstacle stands on it."""
    e = net(spark, sf)
    nodes = e.select("sro_no", F.col("u").alias("node")).union(e.select("sro_no", "v")).distinct()
    cost = routing.dijkstra(e.where("type = 'infra'"), sources(spark, sf), "sro_no", "metres").select("sro_no", "node", "cost")
    found = F.col("cost").isNotNull()
    return nodes.join(cost, ["sro_no", "node"], "left").select("sro_no", "node", F.when(found & (F.col("node") % 4 != 3), "AUTO").otherwise("MANUAL_REVIEW").alias("status"), found.alias("infra_existante"))


_RANK = "case src when 'ft' then 0 when 'chem' then 0 when 'athd' then 1 when 'bt' then 3 else 5 end"


@query(oracle("chain", f"select a, b, arg_min(seq, r) as seq, string_agg(distinct cast(pb as string), '|' order by cast(pb as string)) as _used_by_paths, count(*) - 1 as n_removed from (select *, least(node_a, node_b) as a, greatest(node_a, node_b) as b, row_number() over (partition by least(node_a, node_b), greatest(node_a, node_b) order by {_RANK}, metres, seq) as r from chain) group by a, b"))
def t6_near_duplicates(spark, sf):
    rows = layer(spark, sf, "chain").select("*", F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return topology.duplicates_merged(rows, ["a", "b"], [at.hierarchy(), F.col("metres"), F.col("seq")], "pb", ["seq"])


@query(oracle("chain", "select pb, sum(runs)::bigint - 1 as switches, count(*) filter (where runs > 1) as suspicious from (select pb, src, sum(fresh) as runs from (select pb, src, case when src = lag(src) over (partition by pb order by seq) then 0 else 1 end as fresh from chain where src <> 'ign') group by pb, src) group by pb"))
def t14_support_switches(spark, sf):
    return topology.support_switches(layer(spark, sf, "chain"), ["pb"], "seq", F.when(F.col("src") != "ign", F.col("src")))


@query(oracle("chain", "select seq from chain c where src = 'bt' and pb % 3 = 0 and exists (select 1 from chain o where o.src in ('ft', 'chem', 'athd') and least(o.node_a, o.node_b) = least(c.node_a, c.node_b) and greatest(o.node_a, o.node_b) = greatest(c.node_a, c.node_b))"))
def t7_redundant_energy(spark, sf):
    """Energy rows without paths that have a telecom twin between the same ends."""
    rows = layer(spark, sf, "chain").select("*", F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    twins = rows.where("src in ('ft', 'chem', 'athd')").select("a", "b").distinct()
    return rows.where("src = 'bt' and pb % 3 = 0").join(twins, ["a", "b"], "left_semi").select("seq")


@query()
def t20_purge_fixpoint(spark, sf):
    chain = layer(spark, sf, "chain")
    node = lambda c: F.col("sro_no") * 100_000 + (F.col("pb") % 40) * 1000 + F.col(c)
    rows = chain.select("seq", node("node_a").alias("a"), node("node_b").alias("b"), F.col("pb").alias("path"))
    anchors = rows.groupBy("path").agg(F.min("a").alias("pa_node"), F.max("b").alias("pb_node"))
    return topology.purged(rows, anchors).select("seq")


_STEP = "case when regexp_matches(line, '^=== SRO (\\S+) ===') then 0 when regexp_matches(line, '^\\[OK\\] SRO (\\S+) traite') then 11 " + " ".join(f"when contains(line, '{m}') then {k}" for k, m in enumerate(progress.MARKERS, 1)) + " end"


@query(oracle("log", "select running as area_no, max(regexp_extract(line, '^=== SRO (\\S+) ===', 1)) as area, coalesce(max(step), 0) as step, least(1e2, ((running - 1) * 11 + coalesce(max(step), 0)) * 100e0 / (40 * 11)) as percent from m where running > 0 group by running",
 m=f"select line, {_STEP} as step, count(*) filter (where regexp_matches(line, '^=== SRO (\\S+) ===')) over (order by line_no rows unbounded preceding) as running from log"))
def pg1_progress(spark, sf):
    return progress.progress(layer(spark, sf, "log"), "line_no", "line", 40)
