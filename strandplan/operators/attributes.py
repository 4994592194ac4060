"""Filters, classifications, aggregates and rankings of planning layers: attribute work without geometry joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks, codes, factors and thresholds that results depend on.
BURIED_MARKS = ("cable enterre", "cable enterree", "câble enterré")
SOURCE_TAGS = {"athd": ("7", "E"), "bt": ("1", "E"), "chem": ("C7", "E")}
ROUTE_FACTORS = {"infra": 1, "gc_neuf": 10, "ign_route": 30}
D3_LIMIT = 100.0
ROAD_CLASSES = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "service", "living_street", "pedestrian")
HIERARCHY = {"ft": 0, "chem": 0, "athd": 1, "bt": 3, "gc_neuf": 4}
AUTO_TARGET = 80.0
STYLE_CODES = ("C0", "E0", "E1", "E2", "E3", "E7", "C7")


def number(c) -> Column:
    """A number of dirty text, null if it isn't one."""
    return F.expr(f"try_cast(nullif(trim(cast({c} as string)), '') as double)")


# ------------------------------------------------------------------ reusable infrastructure


def athd_reusable(df: DataFrame) -> DataFrame:
    if "dispopp_ar" not in df.columns:
        return df.limit(0)
    return df.where(F.coalesce(number("dispopp_ar"), F.lit(0.0)) >= 1)


def bt_not_buried(df: DataFrame) -> DataFrame:
    """A null type stays."""
    if "type_de_lien" not in df.columns:
        return df.limit(0)
    kind = F.lower(F.coalesce("type_de_lien", F.lit("")))
    buried = F.lit(False)
    for mark in BURIED_MARKS:
        buried = buried | kind.contains(mark)
    return df.where(~buried)


def ft_open(df: DataFrame) -> DataFrame:
    """Without existing rows of pose 4; nulls stay, and a table without the columns is passed on."""
    if not {"statut", "mode_pose"} <= set(df.columns):
        return df
    return df.where(~F.coalesce((F.col("statut") == "E") & (number("mode_pose") == 4), F.lit(False)))


def chem_usable(df: DataFrame) -> DataFrame:
    if not {"cm_avct", "cm_typ_imp", "cm_typelog"} <= set(df.columns):
        return df.limit(0)
    code = F.concat(F.coalesce("cm_avct", F.lit("")), F.coalesce("cm_typ_imp", F.lit("")))
    return df.where((code == "C7") & F.col("cm_typelog").isin("TR", "TD"))


def tagged(df: DataFrame, src: str) -> DataFrame:
    """src and its fixed pose and status; ft keeps its own."""
    df = df.withColumn("src", F.lit(src))
    if src in SOURCE_TAGS:
        pose, status = SOURCE_TAGS[src]
        df = df.withColumn("mode_pose", F.lit(pose)).withColumn("statut", F.lit(status))
    return df


def reusable(parts: dict[str, DataFrame]) -> DataFrame:
    """The union of the filtered and tagged sources."""
    keep = {"athd": athd_reusable, "bt": bt_not_buried, "ft": ft_open, "chem": chem_usable}
    out = None
    for src, df in parts.items():
        one = tagged(keep[src](df), src)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def reusable_of(infra: DataFrame) -> DataFrame:
    """The same of one table with a src column, in a single scan."""
    kind = F.lower(F.coalesce("type_de_lien", F.lit("")))
    buried = F.lit(False)
    for mark in BURIED_MARKS:
        buried = buried | kind.contains(mark)
    code = F.concat(F.coalesce("cm_avct", F.lit("")), F.coalesce("cm_typ_imp", F.lit("")))
    ok = (
        F.when(F.col("src") == "athd", F.coalesce(number("dispopp_ar"), F.lit(0.0)) >= 1)
        .when(F.col("src") == "bt", ~buried)
        .when(F.col("src") == "ft", ~F.coalesce((F.col("statut") == "E") & (number("mode_pose") == 4), F.lit(False)))
        .when(F.col("src") == "chem", (code == "C7") & F.coalesce(F.col("cm_typelog").isin("TR", "TD"), F.lit(False)))
        .otherwise(F.lit(False))
    )
    pose, status = F.col("mode_pose"), F.col("statut")
    for src, (p, s) in SOURCE_TAGS.items():
        pose, status = F.when(F.col("src") == src, F.lit(p)).otherwise(pose), F.when(F.col("src") == src, F.lit(s)).otherwise(status)
    return infra.where(ok).withColumns({"mode_pose": pose, "statut": status})


# ------------------------------------------------------------------ expressions


def is_public() -> Column:
    return F.lower(F.coalesce("proprietaire", F.lit(""))).contains("commune")


def road_allowed() -> Column:
    return F.col("highway").isNull() | F.col("highway").isin(*ROAD_CLASSES)


def is_energy() -> Column:
    return F.coalesce(F.col("mode_pose") == "1", F.lit(False)) | F.coalesce(F.lower("src") == "bt", F.lit(False))


def sockets_weight(c: str = "prises") -> Column:
    v = number(c)
    return F.when((v > 0) & ~F.isnan(v), v).otherwise(F.lit(1.0))


def route_weight(length: str, kind: str = "type") -> Column:
    out = F.lit(1)
    for k, v in ROUTE_FACTORS.items():
        out = F.when(F.col(kind) == k, F.lit(v)).otherwise(out)
    return F.col(length) * out


def d3_class(d: Column) -> Column:
    return F.when(d.isNull() | (d > D3_LIMIT), F.lit("TO_CREATE")).otherwise(F.lit("AUTO_OK"))


def support_family() -> Column:
    aerial = (F.col("src") == "ft") & (F.col("mode_pose") == "0")
    return F.when(aerial, F.lit("aerial_telecom")).when(F.col("src").isin("ft", "chem"), F.lit("telecom_duct")).when(F.col("src") == "athd", F.lit("athd")).when(F.col("src") == "bt", F.lit("energy"))


def hierarchy() -> Column:
    out = F.lit(5)
    for k, v in HIERARCHY.items():
        out = F.when(F.col("src") == k, F.lit(v)).otherwise(out)
    return out


def snap_tier(kind: str = "type") -> Column:
    return F.when(F.col(kind) == "infra", 0).when(F.col(kind) == "ign_route", 1).otherwise(2)


def parcel_name() -> Column:
    return F.coalesce("id_metier", "idu", F.concat(F.lit("parcel#"), F.col("seq").cast("string")))


def sro_prefix(c: str = "sro") -> Column:
    """The first two parts; an error if there are fewer."""
    return F.when(F.size(F.split(c, "/")) < 2, F.raise_error(F.concat(F.lit("no prefix in "), F.col(c)))).otherwise(F.substring_index(c, "/", 2))


def style_code() -> Column:
    """Style class of status and pose; coalesced first, as a null would hide a C0."""
    code = F.concat(F.coalesce("statut", F.lit("")), F.coalesce("mode_pose", F.lit("")))
    return F.when(code.isin(*STYLE_CODES), code).otherwise(F.lit("ELSE"))


def path_set(c: Column) -> Column:
    """A set of path ids of dirty text: ',' or '|' between, trimmed, empty ones dropped, sorted, joined by '|'."""
    parts = F.transform(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), ",", "|"), r"\|"), lambda x: F.trim(x))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != ""))), "|")


def layer_file_name(c: Column) -> Column:
    name = F.regexp_replace(F.trim(c), r"[^A-Za-z0-9_\-.]", "_")
    name = F.substring(F.regexp_replace(F.regexp_replace(name, "_+", "_"), "^_|_$", ""), 1, 60)
    return F.when(name == "", F.lit("couche")).otherwise(name)


def cache_key(x0: Column, y0: Column, x1: Column, y1: Column, grown: float = 500.0) -> Column:
    edges = [F.round(e + s * grown).cast("long").cast("string") for e, s in ((x0, -1), (y0, -1), (x1, 1), (y1, 1))]
    return F.substring(F.md5(F.concat_ws("_", *edges)), 1, 12)


# ------------------------------------------------------------------ aggregates and rankings


def counts_by_source(infra: DataFrame, per: str = "sro") -> DataFrame:
    n = [F.count_if(F.col("src") == s).alias(f"n_{s}") for s in ("athd", "bt", "ft", "chem")]
    return infra.groupBy(per).agg(*n, F.count("*").alias("n_total"))


def recap(infra: DataFrame) -> DataFrame:
    """By service area and, under a null, over the whole run."""
    return infra.rollup("sro").agg(F.count("*").alias("n_total"), F.countDistinct("src").alias("n_sources"))


def public_share(parcels: DataFrame) -> DataFrame:
    public = F.count_if(is_public())
    return parcels.groupBy("sro").agg(public.alias("n_public"), F.count_if(~is_public()).alias("n_private"), F.try_divide(100.0 * public, F.count("*").cast("double")).alias("pct_public"))


def first_of(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; the order must be total."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_rn = 1").drop("_rn")


def numbered(df: DataFrame, by: list[str], order: list[Column], start: int, name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) + (start - 1))


def merge_paths(edges: DataFrame, key: list[str], order: str, path: str, keep: list[str]) -> DataFrame:
    """One row for each edge key: the columns of its first committer, and all path ids."""
    return edges.groupBy(*key).agg(*(F.min_by(c, order).alias(c) for c in keep), F.array_join(F.array_sort(F.collect_set(F.col(path).cast("string"))), "|").alias("_used_by_paths"))


def mutualisation(edges: DataFrame, key: list[str], path: str) -> DataFrame:
    used = edges.groupBy(*key).agg(F.countDistinct(path).alias("n"))
    return used.agg(F.count("*").alias("n_edges"), F.count_if(F.col("n") > 1).alias("n_shared"))


def automation(rows: DataFrame, review: Column) -> DataFrame:
    total, manual = F.count("*"), F.count_if(review)
    rate = 100.0 * (total - manual) / total
    return rows.agg(total.alias("total_troncons"), (total - manual).alias("automatises"), manual.alias("a_verifier"), F.format_string("%.1f%%", rate).alias("taux_auto"), (rate < AUTO_TARGET).alias("warning"))
