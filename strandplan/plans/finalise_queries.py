"""Queries on the finalisation of delivered lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.layers import layer, oracle
from ..graphs import stored
from ..operators import attributes as at
from ..operators import delivery, finalise, intervals, script_routes
from .spatial_queries import _islands

Q: dict = {}
S: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def rows(spark, sf):
    """Existing lines, two of three with a path, and roads as works to create without one."""
    infra = layer(spark, sf, "infra")
    none = F.array().cast("array<string>")
    paths = F.when(F.col("seq") % 3 == 0, none).otherwise(F.array(F.concat(F.lit("P"), (F.col("seq") % 50).cast("string"))))
    lines = infra.select("sro", F.col("seq").alias("eid"), "src", "mode_pose", paths.alias("paths"), *finalise.SHAPE)
    works = layer(spark, sf, "road").select("sro", (F.col("seq") + (1 << 40)).alias("eid"), F.lit("gc_neuf").alias("src"), F.lit("C0").alias("mode_pose"), none.alias("paths"), *finalise.SHAPE)
    return lines.unionByName(works)


def public(spark, sf):
    """Communal parcels, and what is in an area and on no parcel."""
    boxes = lambda df, kind: df.select(F.lit(kind).alias("kind"), *(F.col(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")))
    parcels = layer(spark, sf, "parcelle")
    return boxes(parcels.where(at.is_public()), intervals.COMMUNAL).unionByName(boxes(parcels, intervals.PARCEL)).unionByName(boxes(layer(spark, sf, "za_sro"), intervals.AREA))


def _communal(spark, sf):
    return layer(spark, sf, "parcelle").where(at.is_public()).select(*(F.col(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")))


@query()
def r1_healed(spark, sf):
    lines = rows(spark, sf).where("src <> 'gc_neuf'")
    return finalise.healed(lines).groupBy("sro").agg(F.count("*").alias("n_lines"))


@query()
def t4_split_with_paths(spark, sf):
    """Lines cut where ends meet them, with their paths."""
    out = finalise.split_at_ends(stored(finalise.snapped(rows(spark, sf).where("src <> 'gc_neuf'")))[0])
    return out.groupBy("sro").agg(F.count("*").alias("n_lines"), F.sum(F.size("paths")).alias("n_paths"))


_AFTER = "select * from infra where not ((src = 'bt' or mode_pose = '1') and seq % 3 = 0 and seq not in (select seq from islands where t0 <= 0 and t1 >= 1))"
_KEY = "case when (floor(x1 * 1000 + 5e-1) / 1000, floor(y1 * 1000 + 5e-1) / 1000) <= (floor(x2 * 1000 + 5e-1) / 1000, floor(y2 * 1000 + 5e-1) / 1000) then [floor(x1 * 1000 + 5e-1), floor(y1 * 1000 + 5e-1), floor(x2 * 1000 + 5e-1), floor(y2 * 1000 + 5e-1)] else [floor(x2 * 1000 + 5e-1), floor(y2 * 1000 + 5e-1), floor(x1 * 1000 + 5e-1), floor(y1 * 1000 + 5e-1)] end"
_ENERGY_ISLANDS = {k: v.replace("s.src = 'energy'", "(s.src = 'bt' or s.mode_pose = '1')") for k, v in _islands("1e-2", "energy").items()}


@query(oracle("infra parcelle", f"select seq from infra b where (src = 'bt' or mode_pose = '1') and not exists (select 1 from (select sro, {_KEY} as k from after) a where a.sro = b.sro and a.k = {_KEY.replace('x1', 'b.x1').replace('y1', 'b.y1').replace('x2', 'b.x2').replace('y2', 'b.y2')})", **_ENERGY_ISLANDS, after=_AFTER))
def j19_removed_energy(spark, sf):
    """Energy lines that the filter of private ground took out and that no line left has the ends of."""
    lines = rows(spark, sf).where("src <> 'gc_neuf'")
    return finalise.removed_energy(lines, finalise.energy_filtered(lines, _communal(spark, sf))).select(F.col("eid").alias("seq"))


@query()
def t9_reconnected(spark, sf):
    lines = rows(spark, sf).where("src <> 'gc_neuf'")
    return finalise.reconnected(lines, finalise.energy_filtered(lines, _communal(spark, sf)), public(spark, sf))[1]


@query()
def t5_gaps_bridged(spark, sf):
    lines = rows(spark, sf).where("src <> 'gc_neuf'")
    return finalise.gaps_bridged(lines, public(spark, sf)).groupBy("sro", "src").agg(F.count("*").alias("n"))


@query()
def t6_twins_merged(spark, sf):
    lines = rows(spark, sf).where("src <> 'gc_neuf'")
    twins = lines.withColumns({"eid": F.col("eid") + (1 << 41), "x1": F.col("x1") + F.col("eid") % 5 * 0.2, "src": F.lit("bt")})
    return finalise.twins_merged(lines.unionByName(twins)).select(F.col("eid").alias("seq"), "src", F.array_join("paths", "|").alias("paths"))


@query()
def t11_works_dropped(spark, sf):
    return finalise.redundant_works_dropped(rows(spark, sf)).groupBy("sro", "src").agg(F.count("*").alias("n"))


@query()
def r23_finalised(spark, sf):
    """Lines by area after each step of the whole chain."""
    return finalise.finalised(rows(spark, sf), public(spark, sf))[1]


@query()
def r29_script_deliverable(spark, sf):
    """Routes over the road network from attachment points to the buildings of their zones; private parcels are the obstacles."""
    box = lambda df, *more: df.select(*more, *(F.col(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")))
    road = layer(spark, sf, "road").where(at.road_allowed())
    names = ["ax", "ay", "bx", "by"]
    ways = road.select("x1", "y1", "x2", "y2").toDF(*names).unionByName(road.where("oneway <> 'yes'").select("x2", "y2", "x1", "y1").toDF(*names))
    return script_routes.deliverable(
        layer(spark, sf, "pa").select(F.col("seq").alias("paa_id"), "x", "y"), box(layer(spark, sf, "zapa"), F.col("seq").alias("zone_id")),
        layer(spark, sf, "bal").select(F.col("seq").alias("paste_id"), "x", "y"), ways, box(layer(spark, sf, "parcelle").where(~at.is_public())),
    )


@query()
def r14_micro_bridges(spark, sf):
    """Pairs of consecutive lines of an area whose ends are not connected: bridged if they are near, else for review by hand."""
    infra = layer(spark, sf, "infra").where("src = 'ft'")
    node = delivery.node_of
    edges = infra.select("sro", F.col("seq").alias("eid"), node("x1", "y1").alias("u"), node("x2", "y2").alias("v"), F.lit("infra").alias("type"), "src", "statut", "mode_pose", F.lit(1.0).alias("length"), F.lit(True).alias("can"), "x1", "y1", "x2", "y2")
    places = infra.select("sro", node("x1", "y1").alias("node"), F.col("x1").alias("x"), F.col("y1").alias("y")).union(infra.select("sro", node("x2", "y2"), "x2", "y2"))
    roads = layer(spark, sf, "road").select("sro", F.col("seq").cast("string").alias("pa_id"), F.col("seq").cast("string").alias("pb_id"), node("x1", "y1").alias("pa_node"), node("x2", "y2").alias("pb_node"), "x1", "y1", "x2", "y2")
    ends = roads.select("sro", F.col("pa_node").alias("node"), F.col("x1").alias("x"), F.col("y1").alias("y")).union(roads.select("sro", "pb_node", "x2", "y2"))
    return delivery.micro_bridges(edges, roads.select("sro", "pa_id", "pb_id", "pa_node", "pb_node"), places.union(ends), public(spark, sf))[1].groupBy("sro", "flag").agg(F.count("*").alias("n"))
