"""Queries on terminals, splits, sanitising, projections and sink tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom, projection
from ..functions.layers import layer, oracle
from ..operators import attributes as at
from ..operators import routing, spatial, terminals
from .spatial_queries import _D3_ALL, _boxes, _d, _near, _t, d3

Q: dict = {}
S: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def lines(spark, sf, name="infra"):
    return layer(spark, sf, name).select("seq", "x1", "y1", "x2", "y2")


def points(spark, sf, name="pa"):
    return layer(spark, sf, name).select("seq", "x", "y")


@query(oracle("za_sro", "select sro, count(*) as n, count(*) = 1 as ok from za_sro group by sro"))
def src3_one_area(spark, sf):
    return layer(spark, sf, "za_sro").groupBy("sro").agg(F.count("*").alias("n"), (F.count("*") == 1).alias("ok"))


@query(oracle("parcelle road", "select 'prive' as type, seq, null::string as highway from parcelle where not contains(lower(coalesce(proprietaire, '')), 'commune') union all select 'route', seq, highway from road"))
def src11_obstacles(spark, sf):
    walls = layer(spark, sf, "parcelle").where(~at.is_public()).select(F.lit("prive").alias("type"), "seq")
    return walls.unionByName(layer(spark, sf, "road").select(F.lit("route").alias("type"), "seq", "highway"), allowMissingColumns=True)


_E, _N, _SC, _R0 = projection.E, projection.N, projection.SCALE, projection.RHO0
_TT = f"tan(0.7853981633974483e0 - radians(lat) / 2e0) / pow((1e0 - sin(radians(lat)) * {_E!r}) / (1e0 + sin(radians(lat)) * {_E!r}), {_E / 2!r})"


@query(oracle("bal", f"select seq, floor((700000e0 + pow({_TT}, {_N!r}) * {_SC!r} * sin((radians(lon) - {projection.math.radians(3.0)!r}) * {_N!r})) * 1e2 + 5e-1) / 1e2 as x, floor((6600000e0 + {_R0!r} - pow({_TT}, {_N!r}) * {_SC!r} * cos((radians(lon) - {projection.math.radians(3.0)!r}) * {_N!r})) * 1e2 + 5e-1) / 1e2 as y from (select seq, 2e0 + x / 5e3 as lon, 45e0 + y / 5e3 as lat from bal)"))
def src10_projected(spark, sf):
    x, y = projection.to_metres(2.0 + F.col("x") / 5000.0, 45.0 + F.col("y") / 5000.0)
    cents = lambda c: F.when(F.isnan(c), c).otherwise(F.floor(c * 100.0 + 0.5) / 100.0)
    return layer(spark, sf, "bal").select("seq", cents(x).alias("x"), cents(y).alias("y"))


@query(oracle("bal", "select sro, max(greatest(abs(x), abs(y))) < 180 as degrees from bal group by sro"))
def t0_crs_guess(spark, sf):
    return layer(spark, sf, "bal").groupBy("sro").agg(projection.looks_like_degrees("x", "y").alias("degrees"))


@query(oracle("pa zapa bal", "select z.seq as zapa_seq, count(b.seq) as n from zapa z left join bal b on b.x > z.x0 and b.x < z.x1 and b.y > z.y0 and b.y < z.y1 group by z.seq"))
def j11_points_in_zone(spark, sf):
    zones = _boxes(layer(spark, sf, "zapa"), F.col("seq").alias("zapa_seq"))
    box = tuple(map(F.col, ("bx0", "by0", "bx1", "by1")))
    inside = spatial.grid_join(zones, points(spark, sf, "bal"), box, spatial.point_box("x", "y"), 300.0).where(geom.in_box("x", "y", *box, strict=True))
    n = inside.groupBy("zapa_seq").agg(F.count("*").alias("n"))
    return zones.select("zapa_seq").join(n, "zapa_seq", "left").select("zapa_seq", F.coalesce("n", F.lit(0)).alias("n"))


_ENDS = "select seq as node_seq, 0 as e, x1 as nx, y1 as ny from infra union all select seq, 1, x2, y2 from infra"
_PN = "sqrt((p.x - n.nx) * (p.x - n.nx) + (p.y - n.ny) * (p.y - n.ny))"


@query(oracle("bal infra", f"select p.seq, m.i as node_seq, m.e as \"end\", m.d as d from (select p.seq, min({{'d': {_PN}, 'i': n.node_seq, 'e': n.e}}) as m from bal p join ends n on {_PN} <= 40 group by p.seq) p", ends=_ENDS))
def j18_nearest_line_end(spark, sf):
    return terminals.nearest_end(points(spark, sf, "bal"), lines(spark, sf), 40.0)


_SNAP = dict(
    roads="select seq as node_seq, x1 as nx, y1 as ny, 0 as e from road union all select seq, x2, y2, 1 from road",
    nodes=f"select p.seq, m.i as target from (select p.seq, min({{'d': {_PN}, 'i': n.node_seq, 'e': n.e}}) as m from pa p join roads n on {_PN} < 50 group by p.seq) p",
    edges=f"select seq, m.i as target from (select p.seq, min({{'d': {_d('p.x', 'p.y', 's.')}, 'i': s.seq}}) as m from pa p join road s on not exists (select 1 from nodes o where o.seq = p.seq) and {_near(200)} and {_d('p.x', 'p.y', 's.')} < 200 group by p.seq)",
)


@query(oracle("pa road", "select p.seq, case when n.seq is not null then 'node' when e.seq is not null then 'split' else 'missing' end as how, coalesce(n.target, e.target) as target from pa p left join nodes n on n.seq = p.seq left join edges e on e.seq = p.seq", **_SNAP))
def r10_terminal_snap(spark, sf):
    return terminals.terminal_snap(points(spark, sf), lines(spark, sf, "road"))


@query(oracle("pa road", "select p.seq, coalesce(cast(n.target as string), 'virtual/' || cast(p.seq as string)) as node from pa p left join nodes n on n.seq = p.seq", **_SNAP))
def r28_script_snap(spark, sf):
    pa = points(spark, sf)
    near = terminals.nearest_end(pa, lines(spark, sf, "road"), 50.0).where("d < 50")
    return pa.join(near, "seq", "left").select("seq", F.coalesce(F.col("node_seq").cast("string"), F.concat(F.lit("virtual/"), F.col("seq").cast("string"))).alias("node"))


@query(oracle("bal infra", f"select p.seq, case when m.d <= 3 then 'visible' when m.d <= 150 then 'logical' else 'missing' end as kind from (select p.seq, min({{'d': {_d('p.x', 'p.y', 's.')}, 'i': s.seq}}) as m from bal p join infra s on s.src = 'ft' and {_near(150)} and {_d('p.x', 'p.y', 's.')} <= 150 group by p.seq) p union all select p.seq, 'missing' from bal p where not exists (select 1 from infra s where s.src = 'ft' and {_near(150)} and {_d('p.x', 'p.y', 's.')} <= 150)"))
def r11_anchor_kind(spark, sf):
    bal = points(spark, sf, "bal")
    near = spatial.nearest(bal, layer(spark, sf, "infra").where("src = 'ft'").select(F.col("seq").alias("line_seq"), "x1", "y1", "x2", "y2"), 150.0, ["seq"], [F.col("line_seq")])
    return bal.join(near, "seq", "left").select("seq", F.coalesce(routing.anchor_kind(F.col("best.d"), F.lit(True)), F.lit("missing")).alias("kind"))


_CONN = dict(
    ends=_ENDS,
    touch=f"select p.seq, m.i as target from (select p.seq, min({{'d': {_PN}, 'i': n.node_seq, 'e': n.e}}) as m from bal p join ends n on {_PN} <= 2e-1 group by p.seq) p",
    best=f"select p.seq, min({{'d': {_d('p.x', 'p.y', 's.')}, 'i': s.seq, 't': {_t('p.x', 'p.y', 's.')}}}) as m from bal p join infra s on not exists (select 1 from touch o where o.seq = p.seq) and {_near(5)} and {_d('p.x', 'p.y', 's.')} <= 5 group by p.seq",
)


@query(oracle("bal infra", "select p.seq, case when o.seq is not null then 'connected' when b.m.t > 0 and b.m.t < 1 and b.m.d <= 2e-1 then 'split' when b.m.t > 0 and b.m.t < 1 and b.m.d <= 3 then 'stub' else 'too_far' end as outcome, coalesce(o.target, b.m.i) as target from bal p left join touch o on o.seq = p.seq left join best b on b.seq = p.seq", **_CONN))
def t2_terminal_connections(spark, sf):
    return terminals.connections(points(spark, sf, "bal"), lines(spark, sf))


@query(oracle("bal infra", "select outcome, count(*) as n from (select case when o.seq is not null then 'connected' when b.m.t > 0 and b.m.t < 1 and b.m.d <= 2e-1 then 'split' when b.m.t > 0 and b.m.t < 1 and b.m.d <= 3 then 'stub' else 'too_far' end as outcome from bal p left join touch o on o.seq = p.seq left join best b on b.seq = p.seq) group by outcome", **_CONN))
def t16_connection_counts(spark, sf):
    return terminals.connections(points(spark, sf, "bal"), lines(spark, sf)).groupBy("outcome").agg(F.count("*").alias("n"))


_CUT = f"select s.seq, {_t('p.x', 'p.y', 's.')} as t from bal p join infra s on {_near(3)} and {_d('p.x', 'p.y', 's.')} <= 3"


@query(oracle("bal infra", """select seq, part, x1 + t0 * (x2 - x1) as px1, y1 + t0 * (y2 - y1) as py1, x1 + t1 * (x2 - x1) as px2, y1 + t1 * (y2 - y1) as py2 from (select s.*, u.t as t0, lead(u.t) over (partition by s.seq order by u.t) as t1, cast(row_number() over (partition by s.seq order by u.t) - 1 as int) as part
 from infra s join (select seq, 0e0 as t from infra union select seq, 1e0 from infra union select c.seq, c.t from cuts c join infra i on i.seq = c.seq where c.t * sqrt((i.x1 - i.x2) * (i.x1 - i.x2) + (i.y1 - i.y2) * (i.y1 - i.y2)) >= 1e-2 and (1 - c.t) * sqrt((i.x1 - i.x2) * (i.x1 - i.x2) + (i.y1 - i.y2) * (i.y1 - i.y2)) >= 1e-2) u on u.seq = s.seq) where t1 is not null""", cuts=_CUT))
def t4_split_lines(spark, sf):
    named = lines(spark, sf).withColumnRenamed("seq", "line_seq")
    pairs = spatial.grid_join(points(spark, sf, "bal"), named, spatial.point_box("x", "y", 3.0), spatial.segment_box("x1", "y1", "x2", "y2"), 100.0)
    s = ("x1", "y1", "x2", "y2")
    cuts = pairs.where(geom.segment_distance("x", "y", *s) <= 3).select(F.col("line_seq").alias("seq"), geom.clamp_t("x", "y", *s).alias("t"))
    return terminals.split_at(lines(spark, sf), cuts)


@query(oracle("bal infra", f"select p.seq, exists (select 1 from ends n where {_PN} <= 1) as on_node from bal p", ends=_ENDS))
def t13_continuity(spark, sf):
    bal = points(spark, sf, "bal")
    on = terminals.nearest_end(bal, lines(spark, sf), terminals.AUDIT).select("seq", F.lit(True).alias("hit"))
    return bal.select("seq").join(on, "seq", "left").select("seq", F.coalesce("hit", F.lit(False)).alias("on_node"))


@query(oracle("infra", "select seq, len(v) as n from (select seq, list_filter(list_transform(range(1, 5), lambda i: case when i = 1 or p[i] <> p[i - 1] then p[i] end), lambda q: q is not null) as v from (select seq, case when seq % 3 = 0 then [{'x': x1, 'y': y1}, {'x': x1, 'y': y1}, {'x': x2, 'y': y2}, {'x': x2, 'y': y2}] else [{'x': x1, 'y': y1}, {'x': x2, 'y': y2}, {'x': x1, 'y': y1}, {'x': x1, 'y': y1}] end as p from infra)) where len(v) >= 2"))
def s14_sanitised_vertices(spark, sf):
    p, q = (F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (("x1", "y1"), ("x2", "y2")))
    raw = F.when(F.col("seq") % 3 == 0, F.array(p, p, q, q)).otherwise(F.array(p, q, p, p))
    return layer(spark, sf, "infra").select("seq", F.size(terminals.sanitised(raw)).alias("n")).where("n >= 2")


@query(oracle("log", "select regexp_extract(line, '^=== SRO (\\S+) ===', 1) as sro, count(*) as n from log where regexp_matches(line, '^=== SRO (\\S+) ===') group by 1"))
def s16_log_starts(spark, sf):
    name = F.regexp_extract("line", r"^=== SRO (\S+) ===", 1)
    return layer(spark, sf, "log").where(name != "").groupBy(name.alias("sro")).agg(F.count("*").alias("n"))


@query(oracle("chain", "select a.pa, list_sort(list_filter(a.ps, lambda v: not list_contains(b.ps, v))) as only_all, len(list_intersect(a.ps, b.ps)) as n_both from (select pa, list(distinct pb) as ps from chain group by pa) a join (select pa, list(distinct pb) as ps from chain where src = 'ign' group by pa) b on a.pa = b.pa"))
def o9_path_set_algebra(spark, sf):
    chain = layer(spark, sf, "chain")
    a, b = chain.groupBy("pa").agg(F.collect_set("pb").alias("a")), chain.where("src = 'ign'").groupBy("pa").agg(F.collect_set("pb").alias("b"))
    return a.join(b, "pa").select("pa", F.array_sort(F.array_except("a", "b")).alias("only_all"), F.size(F.array_intersect("a", "b")).alias("n_both"))


@query(oracle("chain", "select min(seq) as seq, count(*) as n from chain group by least(node_a, node_b), greatest(node_a, node_b), metres having count(*) > 1"))
def r22_exact_duplicates(spark, sf):
    key = [F.least("node_a", "node_b"), F.greatest("node_a", "node_b"), F.col("metres")]
    return layer(spark, sf, "chain").groupBy(*key).agg(F.min("seq").alias("seq"), F.count("*").alias("n")).where("n > 1").select("seq", "n")


@query(oracle("zapa bal", "select id_metier as zapa_id, sro, 'existant' as origine from zapa union all select 'ZN/' || cast(seq as string), sro, 'cree' from bal where prises = 12"))
def snk3_livrable_zapa(spark, sf):
    old = layer(spark, sf, "zapa").select(F.col("id_metier").alias("zapa_id"), "sro", F.lit("existant").alias("origine"))
    return old.unionByName(layer(spark, sf, "bal").where("prises = 12").select(F.concat(F.lit("ZN/"), F.col("seq").cast("string")).alias("zapa_id"), "sro", F.lit("cree").alias("origine")))


@query(oracle("bal infra parcelle", "select seq, sro as sro_code, d3_m, case when d3_m is null or d3_m > 100 then 'TO_CREATE' else 'AUTO_OK' end as cls_d3 from d3", **_D3_ALL))
def snk4_livrable_bal(spark, sf):
    return d3(spark, sf).select("seq", F.col("sro").alias("sro_code"), "d3_m", at.d3_class(F.col("d3_m")).alias("cls_d3"))


@query(oracle("parcelle", "select seq, sro as sro_code, contains(lower(coalesce(proprietaire, '')), 'commune') as is_public from parcelle"))
def snk7_livrable_parcelles(spark, sf):
    return layer(spark, sf, "parcelle").select("seq", F.col("sro").alias("sro_code"), at.is_public().alias("is_public"))


@query(oracle("za_sro", "select sro as sro_code, nom_nro, (x0 + x1) / 2e0 as x, (y0 + y1) / 2e0 as y from za_sro"))
def snk8_area_points(spark, sf):
    return layer(spark, sf, "za_sro").select(F.col("sro").alias("sro_code"), "nom_nro", ((F.col("x0") + F.col("x1")) / 2.0).alias("x"), ((F.col("y0") + F.col("y1")) / 2.0).alias("y"))


@query(oracle("bal infra parcelle", "select flag as flag_type, sro, coalesce(parcel, 'BAT/' || cast(seq as string)) as target from d3 where flag is not null", **_D3_ALL))
def snk9_livrable_flags(spark, sf):
    return d3(spark, sf).where("flag is not null").select(F.col("flag").alias("flag_type"), "sro", F.coalesce("parcel", F.concat(F.lit("BAT/"), F.col("seq").cast("string"))).alias("target"))


@query(oracle("infra", "select src as layer, 'b' as style from infra group by src union all select 'old', 'a'"))
def snk11_style_upsert(spark, sf):
    """Rows of a layer and style replace those that are there: what has no successor stays."""
    new = layer(spark, sf, "infra").select(F.col("src").alias("layer"), F.lit("b").alias("style")).distinct()
    old = new.select("layer", F.lit("a").alias("style")).unionByName(spark.createDataFrame([("old", "a")], "layer string, style string"))
    return old.join(new.select("layer"), "layer", "left_anti").unionByName(new)
