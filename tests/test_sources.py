import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from strandplan.functions.layers import layer
from strandplan.plans.planning import plan_areas
from strandplan.sources.geopackage import GeoPackage
from strandplan.sources.tables import UnknownArea, one_area, read_layer, write_layers
from strandplan.streaming.progress import furthest_steps

SF = "/root/testdata/sf0.001"


def header():
    return b"GP\x00\x01" + struct.pack("<i", 2154)


@pytest.fixture
def package(tmp_path):
    path = str(tmp_path / "a.gpkg")
    point = lambda x, y: header() + struct.pack("<BIdd", 1, 1, x, y)
    pointz = header() + struct.pack("<BIddd", 1, 1001, 7.0, 8.0, 9.0)
    line = struct.pack("<BII4d", 1, 2, 2, 0.0, 0.0, 5.0, 5.0)
    multi = header() + struct.pack("<BII", 1, 5, 2) + line + line
    ring = header() + struct.pack("<BIII8d", 1, 3, 1, 4, 0, 0, 1, 0, 1, 1, 0, 0)
    with sqlite3.connect(path) as db:
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
        db.execute("insert into gpkg_geometry_columns values ('bal', 'geom')")
        db.execute("create table bal (fid integer primary key, geom blob, name text, v real)")
        db.executemany("insert into bal values (?, ?, ?, ?)", [(1, point(1, 2), "a", 1.5), (2, pointz, "b", None), (3, multi, "c", 2.0), (4, ring, None, 3.0), (9, None, "e", 0.0)])
    return path


def test_geopackage(spark, package):
    spark.dataSource.register(GeoPackage)
    df = spark.read.format("geopackage").option("layer", "bal").option("numPartitions", "3").load(package)
    rows = {r.fid: r for r in df.collect()}
    assert df.columns == ["fid", "name", "v", "parts"] and len(rows) == 5
    assert [[tuple(v) for v in p] for p in rows[2].parts] == [[(7.0, 8.0)]]
    assert [len(p) for p in rows[3].parts] == [2, 2] and len(rows[4].parts[0]) == 4 and rows[9].parts is None
    near = spark.read.format("geopackage").option("layer", "bal").option("bbox", "0,1.5,6,6").load(package)
    assert sorted(r.fid for r in near.collect()) == [1, 3]


def test_areas_and_layers(spark, tmp_path):
    za = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "sro string, v int")
    assert one_area(za, "a").count() == 1
    for bad in ("b", "c"):
        with pytest.raises(UnknownArea):
            one_area(za, bad)
    folder = str(tmp_path)
    assert write_layers({"x": za, "none": za.limit(0)}, folder) == {"x": 3, "none": 0}
    write_layers({"x": za.where("sro = 'a'").withColumn("v", F.lit(7))}, folder)
    df, lacking = read_layer(spark, folder, "x", {"v": "int", "other": "double"})
    assert lacking == ["other"] and sorted((r.sro, r.v) for r in df.collect()) == [("a", 7), ("b", 1), ("b", 2)]


def test_planning_run(spark):
    layers = {n: layer(spark, SF, n) for n in ("bal", "za_sro", "pa", "zapa", "parcelle", "infra", "road")}
    out = plan_areas(layers)
    counts = {k: df.count() for k, df in out.items()}
    assert len(counts) == 9 and counts["livrable_zasro"] == 25 and counts["livrable_pa"] > layers["pa"].count()
    assert 0 < counts["livrable_bal"] <= layers["bal"].count()
    assert set(plan_areas(layers, "d3")) == {"livrable_infra", "livrable_bal", "livrable_flags"}


def test_streamed_progress(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [("r1", "=== SRO A ===", "2024-01-01 00:00:00"), ("r1", "[WELD]", "2024-01-01 00:01:00"), ("r1", "noise", "2024-01-01 00:02:00"), ("r2", "[OK] SRO B traite", "2024-01-01 00:01:00")]
    spark.createDataFrame(rows, "run string, line string, ts string").select("run", "line", F.to_timestamp("ts").alias("ts")).write.parquet(folder)
    stream = spark.readStream.schema("run string, line string, ts timestamp").parquet(folder)
    q = furthest_steps(stream).writeStream.outputMode("complete").format("memory").queryName("steps").start()
    q.processAllAvailable()
    q.stop()
    assert {r.run: r.step for r in spark.table("steps").collect()} == {"r1": 5, "r2": 11}
