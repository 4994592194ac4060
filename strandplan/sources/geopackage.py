"""A reader of GeoPackage layers (SQLite files), as a Python data source.

    spark.dataSource.register(GeoPackage)
    spark.read.format("geopackage").option("layer", "bal").load(path)

Columns are the table's, without the geometry, and ``parts``: array of rings or lines (a point is a line of one vertex), each an
array of (x, y); further dimensions are dropped.  ``bbox`` ("xmin,ymin,xmax,ymax") is applied to each feature's bounds, on the
file's R-tree if it has one.  Rows are dealt to partitions by ranges of the key, ``numPartitions`` at most.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType

POINT = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
_ENVELOPE = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def decode_wkb(blob: bytes, at: int = 0) -> tuple[list[list[tuple[float, float]]], int]:
    """(parts, position after) of one geometry; collections are flattened."""
    order = "<" if blob[at] else ">"
    (code,) = struct.unpack_from(order + "I", blob, at + 1)
    at += 5
    if code & 0x20000000:
        at += 4
    flags = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    kind, family = code % 1000, code // 1000
    size = max(flags, {0: 2, 1: 3, 2: 3, 3: 4}.get(family, 2))

    def vertices(at: int, n: int) -> tuple[list[tuple[float, float]], int]:
        flat = struct.unpack_from(f"{order}{n * size}d", blob, at)
        return [(flat[i * size], flat[i * size + 1]) for i in range(n)], at + 8 * n * size

    if kind == 1:
        part, at = vertices(at, 1)
        return [part], at
    (n,) = struct.unpack_from(order + "I", blob, at)
    at += 4
    if kind == 2:
        part, at = vertices(at, n)
        return [part], at
    parts: list[list[tuple[float, float]]] = []
    for _ in range(n):
        if kind == 3:
            (m,) = struct.unpack_from(order + "I", blob, at)
            part, at = vertices(at + 4, m)
            parts.append(part)
        else:
            more, at = decode_wkb(blob, at)
            parts += more
    return parts, at


def decode(blob: bytes | None) -> list[list[tuple[float, float]]] | None:
    """Of a GeoPackage geometry (header, envelope, WKB); null and empty ones are null."""
    if blob is None or blob[:2] != b"GP" or blob[3] & 0x10:
        return None
    return decode_wkb(blob, 8 + _ENVELOPE[(blob[3] >> 1) & 7])[0]


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.layer = options["path"].removeprefix("file:"), options["layer"]
        self.bbox = [float(v) for v in options["bbox"].split(",")] if options.get("bbox") else None
        self.n = int(options.get("numPartitions", "8"))
        self.names = [f.name for f in schema.fields if f.name != "parts"]

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            lo, hi = db.execute(f'select min(rowid), max(rowid) from "{self.layer}"').fetchone()
        if lo is None:
            return [_Range(0, 0)]
        step = max(1, -(-(hi - lo + 1) // self.n))
        return [_Range(k, min(k + step, hi + 1)) for k in range(lo, hi + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            (geometry,) = db.execute("select column_name from gpkg_geometry_columns where table_name = ?", (self.layer,)).fetchone()
            tree = db.execute("select 1 from sqlite_master where name = ?", (f"rtree_{self.layer}_{geometry}",)).fetchone()
            columns = ", ".join(f'"{c}"' for c in [geometry, *self.names])
            where, values = "rowid >= ? and rowid < ?", [partition.lo, partition.hi]
            if self.bbox and tree:
                where += f' and rowid in (select id from "rtree_{self.layer}_{geometry}" where maxx >= ? and maxy >= ? and minx <= ? and miny <= ?)'
                values += self.bbox
            for geom, *rest in db.execute(f'select {columns} from "{self.layer}" where {where} order by rowid', values):
                parts = decode(geom)
                if self.bbox:
                    vs = [v for p in parts or () for v in p]
                    if not vs or max(v[0] for v in vs) < self.bbox[0] or max(v[1] for v in vs) < self.bbox[1] or min(v[0] for v in vs) > self.bbox[2] or min(v[1] for v in vs) > self.bbox[3]:
                        continue
                yield (*rest, parts)


class GeoPackage(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> StructType:
        path, layer = self.options["path"].removeprefix("file:"), self.options["layer"]
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
            info = db.execute(f'pragma table_info("{layer}")').fetchall()
            (geometry,) = db.execute("select column_name from gpkg_geometry_columns where table_name = ?", (layer,)).fetchone()
        fields = [StructField(name, self._kind(kind)) for _, name, kind, *_ in info if name != geometry]
        return StructType([*fields, StructField("parts", ArrayType(ArrayType(POINT)))])

    @staticmethod
    def _kind(kind: str) -> DataType:
        kind = kind.upper()
        if "BOOL" in kind:
            return BooleanType()
        if "INT" in kind:
            return LongType()
        return DoubleType() if any(k in kind for k in ("REAL", "DOUB", "FLOA")) else StringType()

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)
