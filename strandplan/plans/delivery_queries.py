"""Queries on what is delivered: snaps of loose ends, planned works, flags, statuses, rates, generated fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom
from ..functions.layers import layer, oracle
from ..operators import attributes as at
from ..operators import clusters, intervals, placement, routing, spatial
from .graph_queries import _EXISTING, _NET, _walk, net, sources
from .spatial_queries import _boxes, _d, _islands, _near, _t, p3_pb_placement
from .spatial_queries import S as SPATIAL_SQL

Q: dict = {}
S: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


_TIER = "case src when 'ft' then 0 when 'chem' then 1 else 2 end"


@query(oracle("infra", f"""select seq, m.i as target, m.d as d from (select e.seq, min({{'k': {_TIER.replace('src', 's.src')}, 'd': {_d('e.x', 'e.y', 's.')}, 'i': s.seq}}) as m from (select seq, sro, x2 as x, y2 as y from infra where src = 'athd') e
 join infra s on s.sro = e.sro and s.seq <> e.seq and {_near(3, p='e.')} and {_d('e.x', 'e.y', 's.')} <= 3 and {_t('e.x', 'e.y', 's.')} > 0 and {_t('e.x', 'e.y', 's.')} < 1 group by e.seq)"""))
def r6_endpoint_to_line(spark, sf):
    """Loose ends go to a place strictly inside the line of the best tier, then the nearest, within 3 m."""
    infra = layer(spark, sf, "infra")
    ends = infra.where("src = 'athd'").select("sro", "seq", F.col("x2").alias("x"), F.col("y2").alias("y"))
    tier = F.when(F.col("src") == "ft", 0).when(F.col("src") == "chem", 1).otherwise(2)
    lines = infra.select("sro", F.col("seq").alias("target"), tier.alias("k"), "x1", "y1", "x2", "y2")
    pairs = spatial.grid_join(ends, lines, spatial.point_box("x", "y", 3.0), spatial.segment_box("x1", "y1", "x2", "y2"), 100.0, ["sro"])
    s = ("x1", "y1", "x2", "y2")
    t, d = geom.clamp_t("x", "y", *s), geom.segment_distance("x", "y", *s)
    best = pairs.where((F.col("seq") != F.col("target")) & (t > 0) & (t < 1) & (d <= 3)).groupBy("seq").agg(F.min(F.struct("k", d.alias("d"), "target")).alias("m"))
    return best.select("seq", "m.target", "m.d")


_ROAD_ISLANDS = {k: v.replace("from infra s join parcelle b on s.src = 'road'", "from road s join parcelle b on true") for k, v in _islands("1e-2", "road").items()}


@query(oracle("road parcelle", "select s.seq, case when coalesce(bool_or(t0 <= 0 and t1 >= 1), false) then 'accepted' else 'GC_NEUF_PRIVATE_CROSSING' end as outcome from road s left join islands i on i.seq = s.seq group by s.seq", **_ROAD_ISLANDS))
def r4_planned_works(spark, sf):
    """Planned works are taken if public ground covers them; else they raise a flag."""
    lines = layer(spark, sf, "road").select("seq", "x1", "y1", "x2", "y2")
    cover = intervals.covered(lines, _boxes(layer(spark, sf, "parcelle").where(at.is_public())), ["seq"], cell=150.0)
    return cover.select("seq", F.when(F.col("covered"), "accepted").otherwise("GC_NEUF_PRIVATE_CROSSING").alias("outcome"))


@query(oracle("net", "select n.sro_no, n.node, 'unreachable_after_pass2' as reason from (select distinct sro_no, u as node from e union select distinct sro_no, v from e) n where not exists (select 1 from w1 c where c.sro_no = n.sro_no and c.node = n.node)",
 e=_NET, w1_e=_EXISTING, w1=_walk("w1")))
def r15_unreachable(spark, sf):
    e = net(spark, sf)
    nodes = e.select("sro_no", F.col("u").alias("node")).union(e.select("sro_no", "v")).distinct()
    cost = routing.dijkstra(e.where("type = 'infra'"), sources(spark, sf), "sro_no", "metres").select("sro_no", "node")
    return nodes.join(cost, ["sro_no", "node"], "left_anti").withColumn("reason", F.lit("unreachable_after_pass2"))


_P3 = SPATIAL_SQL["p3_pb_placement"]


@query(f"select seq, case when status = 'INCERTAIN' then 'PRIVE' else status end as status from ({_P3})")
def p4_legacy_status(spark, sf):
    return p3_pb_placement(spark, sf).select("seq", F.when(F.col("status") == "INCERTAIN", "PRIVE").otherwise(F.col("status")).alias("status"))


@query(f"select status, count(*) as n from ({_P3}) group by status")
def p5_status_counts(spark, sf):
    return p3_pb_placement(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


@query(oracle("chain", "select pa, count(*) as total, count(*) filter (where defect <> '') as manual, count(*) filter (where defect <> '') * 100e0 / count(*) > 20 as warning from chain group by pa"))
def a14_rate_by_zone(spark, sf):
    manual = F.count_if(F.col("defect") != "")
    return layer(spark, sf, "chain").groupBy("pa").agg(F.count("*").alias("total"), manual.alias("manual"), (manual * 100.0 / F.count("*") > 20).alias("warning"))


@query(oracle("chain", "select src, string_agg(distinct cast(pa as string), '|' order by cast(pa as string)) as paths from chain group by src"))
def a11_path_union(spark, sf):
    return layer(spark, sf, "chain").groupBy("src").agg(F.array_join(F.array_sort(F.collect_set(F.col("pa").cast("string"))), "|").alias("paths"))


@query(oracle("chain", "select sro_no, seq, src from (select *, row_number() over (partition by sro_no order by metres desc, seq) as r from chain) where r <= 10"))
def o5_top_rows(spark, sf):
    from pyspark.sql import Window

    r = F.row_number().over(Window.partitionBy("sro_no").orderBy(F.desc("metres"), "seq"))
    return layer(spark, sf, "chain").withColumn("r", r).where("r <= 10").select("sro_no", "seq", "src")


@query(oracle("infra", "select seq, sro as sro_code, case when src = 'athd' then 'athd' else 'other' end as infra_type, coalesce(statut, '') as statut from infra"))
def snk5_livrable_infra(spark, sf):
    kind = F.when(F.col("src") == "athd", "athd").otherwise("other")
    return layer(spark, sf, "infra").select("seq", F.col("sro").alias("sro_code"), kind.alias("infra_type"), F.coalesce("statut", F.lit("")).alias("statut"))


@query(oracle("bal", "select 'PB_' || sro || '_' || cast(row_number() over (partition by sro order by seq) as string) as pb_id, sro, seq from bal where prises > 9"))
def snk6_livrable_pb(spark, sf):
    rows = at.numbered(layer(spark, sf, "bal").where("prises > 9"), ["sro"], [F.col("seq")], 1, "n")
    return rows.select(F.concat(F.lit("PB_"), "sro", F.lit("_"), F.col("n").cast("string")).alias("pb_id"), "sro", "seq")


@query("select i as grid_no, cast(case when i < 11 then 0 else (i - 11) * 500 end as double) as x1, cast(case when i < 11 then i * 500 else 0 end as double) as y1, cast(case when i < 11 then 5000 else (i - 11) * 500 end as double) as x2, cast(case when i < 11 then i * 500 else 5000 end as double) as y2 from range(22) t(i)")
def src14_mock_roads(spark, sf):
    """A fixture: 22 lines on a grid of 500 m."""
    i = F.col("id")
    flat = i < 11
    pick = lambda a, b: F.when(flat, a).otherwise(b).cast("double")
    return spark.range(22).select(i.alias("grid_no"), pick(F.lit(0), (i - 11) * 500).alias("x1"), pick(i * 500, F.lit(0)).alias("y1"), pick(F.lit(5000), (i - 11) * 500).alias("x2"), pick(i * 500, F.lit(5000)).alias("y2"))


@query(oracle("infra", "select seq, case when (x1, y1) <= (x2, y2) then concat_ws('::', cast(cast(x1 as bigint) as string) || ',' || cast(cast(y1 as bigint) as string), cast(cast(x2 as bigint) as string) || ',' || cast(cast(y2 as bigint) as string)) else concat_ws('::', cast(cast(x2 as bigint) as string) || ',' || cast(cast(y2 as bigint) as string), cast(cast(x1 as bigint) as string) || ',' || cast(cast(y1 as bigint) as string)) end as edge_key from infra"))
def s5_edge_key(spark, sf):
    p, q = (F.struct(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")) for a, b in (("x1", "y1"), ("x2", "y2")))
    ends = F.array_sort(F.array(p, q))
    return layer(spark, sf, "infra").select("seq", F.array_join(F.transform(ends, lambda e: F.concat_ws(",", e["x"].cast("string"), e["y"].cast("string"))), "::").alias("edge_key"))


def _grouped(spark, sf):
    weighed = placement.orphans(layer(spark, sf, "bal"), layer(spark, sf, "zapa")).withColumn("w", at.sockets_weight()).select("sro", "seq", "w", "x", "y")
    return clusters.distance_clusters(weighed, "seq", 600.0, ["sro"])


@query()
def c2_c3_attachment_groups(spark, sf):
    """Light clusters merged, heavy ones split by weighted k-means."""
    return clusters.attachment_groups(_grouped(spark, sf))


@query()
def c4_capacity_buckets(spark, sf):
    return clusters.branching_buckets(_grouped(spark, sf))
