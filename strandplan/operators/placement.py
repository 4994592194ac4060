"""Composites: attachment points for orphan buildings, branching points for zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom
from ..graphs import checkpointed
from . import attributes as at
from . import clusters, spatial

CLUSTER_GAP, BRANCH_GAP, SNAP, FALLBACK, BRANCH_SNAP = 7000.0, 100.0, 200.0, 500.0, 500.0


def orphans(bal: DataFrame, zapa: DataFrame) -> DataFrame:
    """Buildings whose zone is null or unknown."""
    known = zapa.select(F.col("id_metier").alias("zapa")).dropna().distinct()
    return bal.join(known, "zapa", "left_anti")


def attachment_points(bal: DataFrame, zapa: DataFrame, infra: DataFrame, parcels: DataFrame) -> DataFrame:
    """sro, pa_id, x, y, snap_source, flag, nb_bat, nb_prises for the orphan buildings of every area.

    Clusters by distance, light ones merged, heavy ones split; each group's weighted centre goes to the nearest cheminement or
    ATHD line within 200 m, else the nearest public parcel within 500 m, else stays where it is.
    """
    weighed = orphans(bal, zapa).withColumn("w", at.sockets_weight()).select("sro", "seq", "w", "x", "y")
    grouped = clusters.distance_clusters(weighed, "seq", CLUSTER_GAP, ["sro"])
    groups = weighed.join(clusters.attachment_groups(grouped), ["sro", "seq"])
    centre = clusters.weighted_centroids(groups, ["sro", "grp"], F.col("w")).withColumnsRenamed({"cx": "x", "cy": "y"})
    lines = infra.where("src in ('chem', 'athd')").select(F.col("seq").alias("infra_seq"), F.col("src").alias("line_src"), F.when(F.col("src") == "chem", 0).otherwise(1).alias("src_order"), "x1", "y1", "x2", "y2")
    snap = spatial.nearest(centre, lines, SNAP, ["sro", "grp"], [F.col("src_order"), F.col("infra_seq"), F.col("line_src")])
    snap = snap.select("sro", "grp", F.col("best.qx").alias("sx"), F.col("best.qy").alias("sy"), F.col("best.line_src").alias("line_src"))
    public = parcels.where(at.is_public()).select(F.col("seq").alias("parcel_seq"), F.col("x0").alias("bx0"), F.col("y0").alias("by0"), F.col("x1").alias("bx1"), F.col("y1").alias("by1"))
    box = tuple(map(F.col, ("bx0", "by0", "bx1", "by1")))
    near = spatial.grid_join(centre, public, spatial.point_box("x", "y", FALLBACK), box, FALLBACK)
    d = geom.box_distance("x", "y", "bx0", "by0", "bx1", "by1")
    inside = lambda p, lo, hi: F.least(F.greatest(F.col(p), F.col(lo)), F.col(hi))
    near = near.where(d <= FALLBACK).groupBy("sro", "grp").agg(F.min(F.struct(d.alias("d"), "parcel_seq", inside("x", "bx0", "bx1").alias("px"), inside("y", "by0", "by1").alias("py"))).alias("p"))
    placed = centre.join(snap, ["sro", "grp"], "left").join(near.select("sro", "grp", "p.px", "p.py"), ["sro", "grp"], "left")
    source = F.when(F.col("sx").isNotNull(), F.when(F.col("line_src") == "chem", "cheminement").otherwise("athd")).when(F.col("px").isNotNull(), "parcelle_publique").otherwise("aucune_infra")
    flag = F.when(F.col("sx").isNotNull(), F.lit(None)).when(F.col("px").isNotNull(), "PA_PLACEMENT_INCERTAIN").otherwise("PA_PLACEMENT_IMPOSSIBLE")
    n = F.row_number().over(Window.partitionBy("sro").orderBy("grp")) + 99000
    return placed.select("sro", F.concat(at.sro_prefix(), F.lit("/PA/"), n.cast("string")).alias("pa_id"), F.coalesce("sx", "px", "x").alias("x"), F.coalesce("sy", "py", "y").alias("y"), source.alias("snap_source"), flag.alias("flag"), F.col("n").alias("nb_bat"), F.col("weight").alias("nb_prises"))


def branching_points(bal: DataFrame, pa: DataFrame, zapa: DataFrame, infra: DataFrame) -> DataFrame:
    """sro, pa_id, pb_id, x, y, nb_prises, bat_count, farthest_seq, snapped: of every attachment point that has a zone of its own id."""
    zones = at.first_of(zapa.where("id_metier is not null"), ["id_metier"], [F.col("seq")]).select("id_metier", F.col("x0").alias("bx0"), F.col("y0").alias("by0"), F.col("x1").alias("bx1"), F.col("y1").alias("by1"))
    own = pa.select("id_metier", F.col("sro").alias("pa_sro"), F.col("seq").alias("pa_seq"), F.col("x").alias("pax"), F.col("y").alias("pay")).join(zones, "id_metier")
    box = (F.col("bx0") - 10, F.col("by0") - 10, F.col("bx1") + 10, F.col("by1") + 10)
    pairs = spatial.grid_join(bal.withColumn("w", at.sockets_weight()).select("seq", "w", "x", "y"), own, spatial.point_box("x", "y"), box, 300.0)
    held = pairs.where(geom.box_distance("x", "y", "bx0", "by0", "bx1", "by1") < 10).select("id_metier", "pa_sro", "pa_seq", "pax", "pay", "seq", "w", "x", "y")
    # a building may be in several zones: its node there is the pair
    nodes = checkpointed(held.withColumn("node", F.col("pa_seq") * F.lit(1 << 40) + F.col("seq")))
    grouped = clusters.distance_clusters(nodes, "node", BRANCH_GAP, ["id_metier"])
    cut = clusters.branching_buckets(grouped.select(F.col("id_metier").alias("sro"), "cluster", F.col("node").alias("seq"), "w", "x", "y"))
    joined = nodes.join(cut.select(F.col("seq").alias("node"), "cluster", "bucket"), "node")
    far = F.max(F.struct(geom.point_distance("x", "y", "pax", "pay").alias("d"), (-F.col("seq")).alias("k"), "x", "y")).alias("far")
    points = joined.groupBy("id_metier", "pa_sro", "cluster", "bucket").agg(far, F.sum("w").alias("nb_prises"), F.count("*").alias("bat_count"))
    points = checkpointed(points.select("id_metier", "pa_sro", "cluster", "bucket", F.col("far.x").alias("x"), F.col("far.y").alias("y"), (-F.col("far.k")).alias("farthest_seq"), "nb_prises", "bat_count"))
    key = ["id_metier", "cluster", "bucket"]
    lines = infra.select(F.col("seq").alias("infra_seq"), "x1", "y1", "x2", "y2")
    snap = spatial.nearest(points, lines, BRANCH_SNAP, key, [F.col("infra_seq")]).select(*key, F.col("best.qx").alias("sx"), F.col("best.qy").alias("sy"))
    n = F.row_number().over(Window.partitionBy("pa_sro").orderBy(*key))
    return points.join(snap, key, "left").select(F.col("pa_sro").alias("sro"), F.col("id_metier").alias("pa_id"), F.concat(F.lit("PB_"), "pa_sro", F.lit("_"), n.cast("string")).alias("pb_id"), F.coalesce("sx", "x").alias("x"), F.coalesce("sy", "y").alias("y"), "nb_prises", "bat_count", "farthest_seq", F.col("sx").isNotNull().alias("snapped"))
