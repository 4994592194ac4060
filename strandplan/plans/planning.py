"""The planning run: layers of all areas in, delivered layers out, as one set of plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom
from ..graphs import checkpointed
from ..operators import attributes as at
from ..operators import delivery, intervals, placement, spatial

STAGES = ("infra", "d3", "points", "routes", "layers")


def _boxes(df: DataFrame, *more) -> DataFrame:
    return df.select(*more, *(F.col(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")))


def energy_on_public_ground(infra: DataFrame, parcels: DataFrame) -> DataFrame:
    """Energy lines cut to communal parcels, in pieces of more than half a metre; other lines whole."""
    bt = infra.where("src = 'bt'")
    parts = intervals.clip(bt.select("seq", "x1", "y1", "x2", "y2"), _boxes(parcels.where(at.is_public())), ["seq"], cell=150.0).select("seq", "t0", "t1")
    cut = bt.join(parts, "seq").withColumns({a: geom.at(t, f"{a[0]}1", f"{a[0]}2") for a, t in (("x1", "t0"), ("y1", "t0"), ("x2", "t1"), ("y2", "t1"))}).select(*infra.columns)
    return infra.where("src <> 'bt'").unionByName(cut)


def measured(bal: DataFrame, infra: DataFrame, parcels: DataFrame) -> DataFrame:
    """bal with parcel, d3_m, cls_d3 and flag."""
    owned = _boxes(parcels, F.col("seq").alias("parcel_seq"), at.is_public().alias("public"), at.parcel_name().alias("parcel"))
    box = tuple(map(F.col, ("bx0", "by0", "bx1", "by1")))
    inside = spatial.grid_join(bal.select("seq", "x", "y"), owned, spatial.point_box("x", "y"), box, 150.0).where(geom.in_box("x", "y", *box, strict=True))
    own = inside.groupBy("seq").agg(F.min(F.struct("parcel_seq", "public", "parcel", *box)).alias("p")).select("seq", "p.*")
    communal = _boxes(parcels.where(at.is_public())).toDF("cx0", "cy0", "cx1", "cy1")
    grown = (F.col("bx0") - 0.5, F.col("by0") - 0.5, F.col("bx1") + 0.5, F.col("by1") + 0.5)
    touching = spatial.grid_join(own, communal, grown, tuple(map(F.col, communal.columns)), 150.0).select("seq").distinct().withColumn("touches", F.lit(True))
    lines = infra.select(F.col("seq").alias("infra_seq"), "x1", "y1", "x2", "y2")
    near = spatial.nearest(bal.select("seq", "x", "y"), lines, 500.0, ["seq"], [F.col("infra_seq")], exact=False)
    public = F.coalesce("public", F.lit(False))
    flag = F.when(F.col("parcel").isNull(), "BAT_HORS_CADASTRE").when(~public & F.col("touches").isNull(), "BAT_ENCLAVE")
    out = bal.join(own, "seq", "left").join(touching, "seq", "left").join(near, "seq", "left").withColumn("d3_m", F.when(public, F.lit(0.0)).otherwise(F.col("best.d")))
    return out.select(*bal.columns, "parcel", "d3_m", at.d3_class(F.col("d3_m")).alias("cls_d3"), flag.alias("flag"))


def public_ground(parcels: DataFrame, za: DataFrame) -> DataFrame:
    """Boxes by kind: what decides whether a place is on public ground."""
    kinds = ((parcels.where(at.is_public()), intervals.COMMUNAL), (parcels, intervals.PARCEL), (za, intervals.AREA))
    out = None
    for df, kind in kinds:
        one = _boxes(df, F.lit(kind).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out


def plan_areas(layers: dict[str, DataFrame], until: str = "layers") -> dict[str, DataFrame]:
    """Delivered layers of every area in ``layers`` (bal, za_sro, pa, zapa, parcelle, infra, road), up to a stage of STAGES.

    Up to "points" livrable_infra is the reusable infrastructure; from "routes" on it is the routed delivery.
    """
    bal, za, pa, zapa, parcels = (layers[n] for n in ("bal", "za_sro", "pa", "zapa", "parcelle"))
    infra = checkpointed(energy_on_public_ground(at.reusable_of(layers["infra"]), parcels))
    out = {"livrable_infra": infra}
    if until == "infra":
        return out
    d3 = checkpointed(measured(bal, infra, parcels))
    in_area = d3.join(_boxes(za, "sro"), "sro").where(geom.in_box("x", "y", "bx0", "by0", "bx1", "by1")).select(*d3.columns)
    flags = d3.where("flag is not null").select(F.col("flag").alias("flag_type"), "sro", F.coalesce("parcel", "id_metier").alias("target"))
    out |= {"livrable_bal": in_area, "livrable_flags": flags}
    if until == "d3":
        return out
    made = checkpointed(placement.attachment_points(bal, zapa, layers["infra"], parcels))
    old = pa.select(F.col("id_metier").alias("pa_id"), "sro", F.lit("existant").alias("origine"), F.lit("").alias("snap_source"), F.lit(0).cast("long").alias("nb_bat"), F.lit(0.0).alias("nb_prises"), "x", "y")
    new = made.select("pa_id", "sro", F.lit("cree").alias("origine"), "snap_source", "nb_bat", "nb_prises", "x", "y")
    created = made.select(F.lit("PA_ORPHELIN_CREE").alias("flag_type"), "sro", F.col("pa_id").alias("target"))
    doubtful = made.where("flag is not null").select(F.col("flag").alias("flag_type"), "sro", F.col("pa_id").alias("target"))
    pas, pbs = old.unionByName(new), checkpointed(placement.branching_points(bal, pa, zapa, infra))
    out |= {"livrable_pa": pas, "livrable_pb": pbs, "livrable_flags": flags.unionByName(created).unionByName(doubtful)}
    if until == "points":
        return out
    routed = delivery.delivered(infra, layers["road"], public_ground(parcels, za), pas, pbs)
    apart = routed["outcomes"].where("outcome <> 'delivered'").select(F.concat(F.lit("PA_PB_DECONNECTES:"), "outcome").alias("flag_type"), "sro", F.col("pb_id").alias("target"))
    out |= {"livrable_infra": routed["rows"], "livrable_flags": out["livrable_flags"].unionByName(apart)}
    if until == "routes":
        return out
    return out | {
        "livrable_zapa": zapa.withColumn("origine", F.lit("existant")),
        "livrable_parcelles": parcels.withColumn("is_public", at.is_public()),
        "livrable_zasro": za,
        "livrable_sro": za.select("sro", "nom_nro", ((F.col("x0") + F.col("x1")) / 2.0).alias("x"), ((F.col("y0") + F.col("y1")) / 2.0).alias("y")),
    }
