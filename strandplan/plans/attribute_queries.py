"""Queries over attributes: filters, classifications, aggregates, rankings, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom
from ..functions.layers import layer, oracle
from ..operators import attributes as at

Q: dict = {}
S: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


_REUSABLE = """select seq, sro, src, x1, y1, x2, y2,
  case src when 'athd' then '7' when 'bt' then '1' when 'chem' then 'C7' else mode_pose end as mode_pose, case when src in ('athd', 'bt', 'chem') then 'E' else statut end as statut
from infra where case src when 'athd' then coalesce(try_cast(dispopp_ar as double), 0) >= 1
  when 'bt' then not (contains(lower(coalesce(type_de_lien, '')), 'cable enterre') or contains(lower(coalesce(type_de_lien, '')), 'câble enterré'))
  when 'ft' then not coalesce(statut = 'E' and try_cast(mode_pose as double) = 4, false)
  else coalesce(cm_avct, '') || coalesce(cm_typ_imp, '') = 'C7' and coalesce(cm_typelog in ('TR', 'TD'), false) end"""


def reusable(spark, sf):
    return at.reusable_of(layer(spark, sf, "infra")).select("seq", "sro", "src", "x1", "y1", "x2", "y2", "mode_pose", "statut")


@query(oracle("za_sro", "select distinct sro from za_sro where sro is not null order by 1"))
def src4_list_sros(spark, sf):
    return layer(spark, sf, "za_sro").select("sro").dropna().distinct().orderBy("sro")


@query(oracle("za_sro", "select sro, substr(md5(concat_ws('_', cast(cast(x0 - 500 as bigint) as string), cast(cast(y0 - 500 as bigint) as string), cast(cast(x1 + 500 as bigint) as string), cast(cast(y1 + 500 as bigint) as string))), 1, 12) as cache_key from za_sro"))
def src7_cache_key(spark, sf):
    return layer(spark, sf, "za_sro").select("sro", at.cache_key(*map(F.col, ("x0", "y0", "x1", "y1"))).alias("cache_key"))


@query(oracle("za_sro bal parcelle infra", """select z.sro, (select count(*) from bal b where b.sro = z.sro) as n_bal,
 (select count(*) from parcelle p where p.x0 <= z.x1 + 150 and p.x1 >= z.x0 - 150 and p.y0 <= z.y1 + 150 and p.y1 >= z.y0 - 150) as n_parcels from za_sro z"""))
def src2_load_areas(spark, sf):
    """Rows of each layer that an area loads: buildings by code, parcels by box and 150 m, all areas in one job."""
    from ..operators.spatial import grid_join

    za = layer(spark, sf, "za_sro").select(F.col("sro").alias("area"), F.col("x0").alias("zx0"), F.col("y0").alias("zy0"), F.col("x1").alias("zx1"), F.col("y1").alias("zy1"))
    bal = layer(spark, sf, "bal").groupBy(F.col("sro").alias("area")).agg(F.count("*").alias("n_bal"))
    box = (F.col("zx0") - 150, F.col("zy0") - 150, F.col("zx1") + 150, F.col("zy1") + 150)
    near = grid_join(za, layer(spark, sf, "parcelle"), box, tuple(map(F.col, ("x0", "y0", "x1", "y1"))), 2000.0).groupBy("area").agg(F.count("*").alias("n_parcels"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return za.join(bal, "area", "left").join(near, "area", "left").select(F.col("area").alias("sro"), zero("n_bal"), zero("n_parcels"))


@query(oracle("infra", "select seq, dispopp_ar from infra where src = 'athd' and coalesce(dispopp_ar, 0) >= 1"))
def f1_athd_available(spark, sf):
    return at.athd_reusable(layer(spark, sf, "infra").where("src = 'athd'")).select("seq", "dispopp_ar")


@query(oracle("infra", "select seq, type_de_lien from infra where src = 'bt' and not (contains(lower(coalesce(type_de_lien, '')), 'cable enterre') or contains(lower(coalesce(type_de_lien, '')), 'câble enterré'))"))
def f2_bt_not_buried(spark, sf):
    return at.bt_not_buried(layer(spark, sf, "infra").where("src = 'bt'")).select("seq", "type_de_lien")


@query(oracle("infra", "select seq, statut, mode_pose from infra where src = 'ft' and not coalesce(statut = 'E' and try_cast(mode_pose as double) = 4, false)"))
def f3_ft_open(spark, sf):
    return at.ft_open(layer(spark, sf, "infra").where("src = 'ft'")).select("seq", "statut", "mode_pose")


@query(oracle("infra", "select seq, cm_typelog from infra where src = 'chem' and coalesce(cm_avct, '') || coalesce(cm_typ_imp, '') = 'C7' and cm_typelog in ('TR', 'TD')"))
def f4_chem_usable(spark, sf):
    return at.chem_usable(layer(spark, sf, "infra").where("src = 'chem'")).select("seq", "cm_typelog")


@query(oracle("infra", "select seq, sro, src, mode_pose, statut from reusable", reusable=_REUSABLE))
def f6_union_reusable(spark, sf):
    infra = layer(spark, sf, "infra")
    parts = {s: infra.where(F.col("src") == s) for s in ("athd", "bt", "ft", "chem")}
    return at.reusable(parts).select("seq", "sro", "src", "mode_pose", "statut")


@query(oracle("infra", "select seq, sro, src, x1, y1, x2, y2, mode_pose, statut from reusable", reusable=_REUSABLE))
def f5_tagged_sources(spark, sf):
    return reusable(spark, sf)


@query(oracle("parcelle", "select seq, contains(lower(coalesce(proprietaire, '')), 'commune') as is_public from parcelle"))
def f7_parcel_public(spark, sf):
    return layer(spark, sf, "parcelle").select("seq", at.is_public().alias("is_public"))


_ROADS = "('motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'unclassified', 'residential', 'service', 'living_street', 'pedestrian')"


@query(oracle("road", f"select seq, highway from road where highway is null or highway in {_ROADS}"))
def f8_road_classes(spark, sf):
    return layer(spark, sf, "road").where(at.road_allowed()).select("seq", "highway")


@query(oracle("infra", "select seq from infra where coalesce(mode_pose = '1', false) or lower(src) = 'bt'"))
def f10_energy_rows(spark, sf):
    return layer(spark, sf, "infra").where(at.is_energy()).select("seq")


@query(oracle("bal", "select seq, case when prises > 0 then cast(prises as double) else 1e0 end as weight from bal"))
def f11_socket_weight(spark, sf):
    return layer(spark, sf, "bal").select("seq", at.sockets_weight().alias("weight"))


@query(oracle("net", "select seq, metres * case type when 'gc_neuf' then 10 when 'ign_route' then 30 else 1 end as weight from net"))
def f12_route_weight(spark, sf):
    return layer(spark, sf, "net").select("seq", at.route_weight("metres").cast("long").alias("weight"))


@query(oracle("infra", """select seq, case when src = 'ft' and mode_pose = '0' then 'aerial_telecom' when src in ('ft', 'chem') then 'telecom_duct' when src = 'athd' then 'athd' when src = 'bt' then 'energy' end as family,
 case src when 'ft' then 0 when 'chem' then 0 when 'athd' then 1 when 'bt' then 3 else 5 end as rank from infra"""))
def f14_support_family(spark, sf):
    return layer(spark, sf, "infra").select("seq", at.support_family().alias("family"), at.hierarchy().alias("rank"))


@query(oracle("net", "select seq, case type when 'infra' then 0 when 'ign_route' then 1 else 2 end as tier from net"))
def f15_snap_tier(spark, sf):
    return layer(spark, sf, "net").select("seq", at.snap_tier().alias("tier"))


@query(oracle("parcelle", "select seq, coalesce(id_metier, idu, 'parcel#' || cast(seq as string)) as name from parcelle"))
def f17_parcel_name(spark, sf):
    return layer(spark, sf, "parcelle").select("seq", at.parcel_name().alias("name"))


@query(oracle("bal", "select seq, split_part(sro, '/', 1) || '/' || split_part(sro, '/', 2) as prefix from bal"))
def f18_sro_prefix(spark, sf):
    return layer(spark, sf, "bal").select("seq", at.sro_prefix().alias("prefix"))


@query(oracle("infra", "select sro, count(*) filter (where src = 'athd') as n_athd, count(*) filter (where src = 'bt') as n_bt, count(*) filter (where src = 'ft') as n_ft, count(*) filter (where src = 'chem') as n_chem, count(*) as n_total from reusable group by sro", reusable=_REUSABLE))
def a1_counts_by_source(spark, sf):
    return at.counts_by_source(reusable(spark, sf))


@query(oracle("infra", "select sro, count(*) as n_total, count(distinct src) as n_sources from reusable group by rollup (sro)", reusable=_REUSABLE))
def a1_recap_rollup(spark, sf):
    return at.recap(reusable(spark, sf))


@query(oracle("parcelle", """select sro, count(*) filter (where contains(lower(coalesce(proprietaire, '')), 'commune')) as n_public, count(*) filter (where not contains(lower(coalesce(proprietaire, '')), 'commune')) as n_private,
 100e0 * count(*) filter (where contains(lower(coalesce(proprietaire, '')), 'commune')) / cast(count(*) as double) as pct_public from parcelle group by sro"""))
def a2_public_share(spark, sf):
    return at.public_share(layer(spark, sf, "parcelle"))


@query(oracle("infra", "select type_de_lien as flag, count(*) as n from infra group by 1 order by n desc"))
def a5_flag_counts(spark, sf):
    return layer(spark, sf, "infra").groupBy(F.col("type_de_lien").alias("flag")).agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query(oracle("bal", "select sro, floor(sum(case when prises > 0 then prises else 1 end * cast(x as bigint)) / cast(sum(case when prises > 0 then prises else 1 end) as double) * 1e6 + 5e-1) / 1e6 as cx, floor(sum(case when prises > 0 then prises else 1 end * cast(y as bigint)) / cast(sum(case when prises > 0 then prises else 1 end) as double) * 1e6 + 5e-1) / 1e6 as cy from bal group by sro"))
def a6_weighted_centroid(spark, sf):
    w = at.sockets_weight().cast("long")
    mean = lambda c: geom.key6(F.sum(w * F.col(c).cast("long")) / F.sum(w).cast("double"))
    return layer(spark, sf, "bal").groupBy("sro").agg(mean("x").alias("cx"), mean("y").alias("cy"))


@query(oracle("chain", "select src, sum(metres)::bigint as metres, count(*) as n from chain group by src"))
def a8_length_by_source(spark, sf):
    return layer(spark, sf, "chain").groupBy("src").agg(F.sum("metres").alias("metres"), F.count("*").alias("n"))


@query(oracle("infra", "select coalesce(statut, '') || coalesce(mode_pose, '') as style_key, count(*) as n, count(*) filter (where statut is null) as n_null_statut, count(*) filter (where mode_pose is null) as n_null_pose from infra group by 1"))
def a9_style_counts(spark, sf):
    key = F.concat(F.coalesce("statut", F.lit("")), F.coalesce("mode_pose", F.lit("")))
    return layer(spark, sf, "infra").groupBy(key.alias("style_key")).agg(F.count("*").alias("n"), F.count_if(F.col("statut").isNull()).alias("n_null_statut"), F.count_if(F.col("mode_pose").isNull()).alias("n_null_pose"))


@query(oracle("chain", "select count(*) as n_edges, count(*) filter (where n > 1) as n_shared from (select least(node_a, node_b) as a, greatest(node_a, node_b) as b, count(distinct pb) as n from chain group by 1, 2)"))
def a10_mutualisation(spark, sf):
    edges = layer(spark, sf, "chain").select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"), "pb")
    return at.mutualisation(edges, ["a", "b"], "pb")


@query(oracle("chain", "select least(node_a, node_b) as a, greatest(node_a, node_b) as b, arg_min(src, seq) as src, arg_min(metres, seq) as metres, string_agg(distinct cast(pb as string), '|' order by cast(pb as string)) as _used_by_paths from chain group by 1, 2"))
def o10_mutualised_edges(spark, sf):
    edges = layer(spark, sf, "chain").select("*", F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return at.merge_paths(edges, ["a", "b"], "seq", "pb", ["src", "metres"])


@query(oracle("chain", "select defect as reason, count(*) as n from chain where defect <> '' group by 1 order by 1"))
def a12_reason_histogram(spark, sf):
    return layer(spark, sf, "chain").where("defect <> ''").groupBy(F.col("defect").alias("reason")).agg(F.count("*").alias("n")).orderBy("reason")


@query(oracle("chain", "select pa, count(*) as n from chain where defect <> '' group by pa order by n desc, pa limit 10"))
def a13_top_manual_zones(spark, sf):
    return layer(spark, sf, "chain").where("defect <> ''").groupBy("pa").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pa").limit(10)


@query(oracle("chain", """select count(*) as total_troncons, count(*) filter (where defect = '') as automatises, count(*) filter (where defect <> '') as a_verifier,
 printf('%.1f%%', 100e0 * count(*) filter (where defect = '') / count(*)) as taux_auto, 100e0 * count(*) filter (where defect = '') / count(*) < 80 as warning from chain"""))
def snk16_quality_report(spark, sf):
    return at.automation(layer(spark, sf, "chain"), F.col("defect") != "")


@query(oracle("chain", "select sro_no, sum(metres) filter (where src = 'ign')::bigint as ign, sum(metres)::bigint as total from chain group by sro_no having sum(metres) filter (where src = 'ign') * 5 > sum(metres)"))
def a15_new_works_warning(spark, sf):
    ign = F.sum(F.when(F.col("src") == "ign", F.col("metres")))
    return layer(spark, sf, "chain").groupBy("sro_no").agg(ign.alias("ign"), F.sum("metres").alias("total")).where("ign * 5 > total")


@query(oracle("infra", "select sro, min(least(x1, x2)) as minx, min(least(y1, y2)) as miny, max(greatest(x1, x2)) as maxx, max(greatest(y1, y2)) as maxy from infra group by sro"))
def a16_total_bounds(spark, sf):
    return layer(spark, sf, "infra").groupBy("sro").agg(F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"), F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"))


@query(oracle("chain", "select node_a, node_b, seq, src from (select *, row_number() over (partition by node_a, node_b order by case when src = 'ign' then 1 else 0 end, metres, seq) as r from chain) where r = 1"))
def o1_dedup_first(spark, sf):
    return at.first_of(layer(spark, sf, "chain"), ["node_a", "node_b"], [F.when(F.col("src") == "ign", 1).otherwise(0), F.col("metres"), F.col("seq")]).select("node_a", "node_b", "seq", "src")


@query(oracle("chain", "select node_a, node_b, seq, src from (select *, row_number() over (partition by node_a, node_b order by case src when 'ft' then 0 when 'chem' then 0 when 'athd' then 1 when 'bt' then 3 else 5 end, metres, seq) as r from chain) where r = 1"))
def o2_best_support(spark, sf):
    return at.first_of(layer(spark, sf, "chain"), ["node_a", "node_b"], [at.hierarchy(), F.col("metres"), F.col("seq")]).select("node_a", "node_b", "seq", "src")


@query(oracle("pa bal", "select p.sro, max_by(b.seq, (b.x - p.x) * (b.x - p.x) + (b.y - p.y) * (b.y - p.y) - b.seq / 1e7) as seq from (select sro, min(seq) as s from pa group by sro) f join pa p on p.seq = f.s join bal b on b.sro = p.sro group by p.sro"))
def o3_farthest_building(spark, sf):
    pa = at.first_of(layer(spark, sf, "pa"), ["sro"], [F.col("seq")]).select("sro", F.col("x").alias("px"), F.col("y").alias("py"))
    square = (F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("y") - F.col("py")) * (F.col("y") - F.col("py"))
    far = layer(spark, sf, "bal").join(pa, "sro").groupBy("sro").agg(F.max(F.struct(square, (-F.col("seq")).alias("k"))).alias("m"))
    return far.select("sro", (-F.col("m.k")).alias("seq"))


@query(oracle("bal", "select seq, split_part(sro, '/', 1) || '/' || split_part(sro, '/', 2) || '/PA/' || cast(99000 + row_number() over (partition by sro order by seq) as string) as pa_id from bal where prises = 7"))
def o7_sequential_ids(spark, sf):
    rows = at.numbered(layer(spark, sf, "bal").where("prises = 7"), ["sro"], [F.col("seq")], 99001, "n")
    return rows.select("seq", F.concat(at.sro_prefix(), F.lit("/PA/"), F.col("n").cast("string")).alias("pa_id"))


@query(oracle("pa bal", "select id_metier as pa_id, sro, 'existant' as origine, '' as snap_source, 0 as nb_prises from pa union all select id_metier, sro, 'cree', 'chem', coalesce(prises, 0) from bal where prises = 12"))
def snk2_livrable_pa(spark, sf):
    old = layer(spark, sf, "pa").select(F.col("id_metier").alias("pa_id"), "sro", F.lit("existant").alias("origine"), F.lit("").alias("snap_source"), F.lit(0).alias("nb_prises"))
    new = layer(spark, sf, "bal").where("prises = 12").select(F.col("id_metier").alias("pa_id"), "sro", F.lit("cree").alias("origine"), F.lit("chem").alias("snap_source"), F.coalesce("prises", F.lit(0)).alias("nb_prises"))
    return old.unionByName(new)


@query(oracle("pa bal zapa", "select 'livrable_pa' as layer, count(*) as n from pa union all select 'livrable_bal', count(*) from bal union all select 'livrable_zapa', count(*) from zapa"))
def snk10_layer_counts(spark, sf):
    one = lambda n: layer(spark, sf, n).agg(F.lit(f"livrable_{n}").alias("layer"), F.count("*").alias("n"))
    return one("pa").union(one("bal")).union(one("zapa"))


@query(oracle("parcelle", "select seq, case when n = '' then 'couche' else n end as file_name from (select seq, substr(regexp_replace(regexp_replace(regexp_replace(trim(coalesce(proprietaire, ' ')), '[^A-Za-z0-9_\\-.]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), 1, 60) as n from parcelle)"))
def snk18_file_names(spark, sf):
    return layer(spark, sf, "parcelle").select("seq", at.layer_file_name(F.coalesce("proprietaire", F.lit(" "))).alias("file_name"))


@query(oracle("infra", "select type_de_lien as name, case when lower(type_de_lien) like '%enterr%' then 'buried' when lower(type_de_lien) like '%facade%' then 'facade' when lower(type_de_lien) like '%rien%' then 'aerial' else 'other' end as role, count(*) as n from infra group by 1, 2"))
def snk19_layer_roles(spark, sf):
    low = F.lower("type_de_lien")
    role = F.when(low.like("%enterr%"), "buried").when(low.like("%facade%"), "facade").when(low.like("%rien%"), "aerial").otherwise("other")
    return layer(spark, sf, "infra").groupBy(F.col("type_de_lien").alias("name"), role.alias("role")).agg(F.count("*").alias("n"))


@query(oracle("infra", "select seq, case when coalesce(statut, '') || coalesce(mode_pose, '') in ('C0', 'E0', 'E1', 'E2', 'E3', 'E7', 'C7') then coalesce(statut, '') || coalesce(mode_pose, '') else 'ELSE' end as style from infra"))
def s12_style_code(spark, sf):
    return layer(spark, sf, "infra").select("seq", at.style_code().alias("style"))


@query(oracle("chain", """select pa, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(replace(raw, ',', '|'), '|'), lambda x: trim(x)), lambda x: x <> ''))), '|') as paths
 from (select pa, string_agg(case when seq % 2 = 0 then ' ' || cast(pb as string) || ',' else cast(pb as string) || ' |' end, '' order by seq) as raw from chain group by pa)"""))
def s13_path_sets(spark, sf):
    piece = F.when(F.col("seq") % 2 == 0, F.concat(F.lit(" "), F.col("pb").cast("string"), F.lit(","))).otherwise(F.concat(F.col("pb").cast("string"), F.lit(" |")))
    raw = layer(spark, sf, "chain").groupBy("pa").agg(F.array_join(F.array_sort(F.collect_list(piece)), "").alias("raw"))
    return raw.select("pa", at.path_set(F.col("raw")).alias("paths"))


@query(oracle("infra", "select seq, floor(x1 / 7e0 * 1e6 + 5e-1) / 1e6 as kx, floor(y1 / 7e0 * 1e6 + 5e-1) / 1e6 as ky, sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)) as length_m from infra"))
def s4_keys_and_lengths(spark, sf):
    return layer(spark, sf, "infra").select("seq", geom.key6(F.col("x1") / 7.0).alias("kx"), geom.key6(F.col("y1") / 7.0).alias("ky"), geom.length().alias("length_m"))


@query(oracle("chain", "select distinct md5(concat_ws('|', least(node_a, node_b), greatest(node_a, node_b), src)) as h from chain"))
def s6_geometry_hash(spark, sf):
    return layer(spark, sf, "chain").select(F.md5(F.concat_ws("|", F.least("node_a", "node_b").cast("string"), F.greatest("node_a", "node_b").cast("string"), "src")).alias("h")).distinct()


@query(oracle("infra", """select sro, seq, p as part, px as x1, py as y1, lead_x as x2, lead_y as y2 from (select *, lead(px) over (partition by seq order by p) as lead_x, lead(py) over (partition by seq order by p) as lead_y
 from (select sro, seq, unnest([0, 1, 2]) as p, unnest([x1, (x1 + x2) / 2e0, x2]) as px, unnest([y1, (y1 + y2) / 2e0, y2]) as py from infra)) where lead_x is not null and (px <> lead_x or py <> lead_y)"""))
def s11_vertex_segments(spark, sf):
    points = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(((F.col("x1") + F.col("x2")) / 2.0).alias("x"), ((F.col("y1") + F.col("y2")) / 2.0).alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    line = layer(spark, sf, "infra").select("sro", "seq", points.alias("g"))
    parts = line.select("sro", "seq", "g", F.posexplode(F.slice("g", 1, F.size("g") - 1)).alias("part", "a")).withColumn("b", F.col("g")[F.col("part") + 1])
    return parts.where("a <> b").select("sro", "seq", "part", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))
