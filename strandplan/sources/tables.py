"""Layer tables on disk: reading with the columns a step needs, writing area by area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Delivered layers in drawing order, the first on top.
LAYER_ORDER = ("livrable_flags", "livrable_sro", "livrable_pa", "livrable_pb", "livrable_bal", "livrable_infra", "livrable_zapa", "livrable_parcelles", "livrable_zasro")


class UnknownArea(ValueError):
    """An area that is not there once."""


def read_layer(spark: SparkSession, folder: str, name: str, columns: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """The layer with all the columns asked for (name: type), and which of them it lacks (null here)."""
    df = spark.read.parquet(f"{folder}/{name}")
    lacking = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(columns[c]) for c in lacking}) if lacking else df, lacking


def one_area(za: DataFrame, sro: str) -> DataFrame:
    """The area's row; an error if there is not exactly one."""
    found = za.where(F.col("sro") == sro)
    n = found.limit(2).count()
    if n != 1:
        raise UnknownArea(f"{sro}: {'no row' if not n else 'more than one row'}")
    return found


def write_layers(layers: dict[str, DataFrame], folder: str, area: str = "sro") -> dict[str, int]:
    """Each layer as Parquet by area; areas in the layer replace those on disk, others stay. Returns rows by layer; empty ones are not written."""
    counts = {}
    for name, df in layers.items():
        if df.isEmpty():
            counts[name] = 0
            continue
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(area).parquet(f"{folder}/{name}")
        counts[name] = df.count()
    return counts
