"""Shapefiles and GeoPackages as Spark data sources: geometry as rings, attributes as columns.

The driver reads headers and counts; a partition is a range of records, which an executor seeks and decodes.
A GeoPackage is a database file and must lie on a mount that executors share.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from . import stores

RING = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))
#: Records of a partition.
BATCH = 50_000


class _Records(InputPartition):
    def __init__(self, first: int, count: int):
        self.first, self.count = first, count


def _cut(first: int, count: int, batch: int) -> list[InputPartition]:
    return [_Records(a, min(batch, first + count - a)) for a in range(first, first + count, batch)] or [_Records(first, 0)]


def _beside(path: str, suffix: str) -> str:
    return path.removesuffix(".shp") + suffix


def shapefile_complete(path: str) -> bool:
    """VF-03: .shp, .dbf and .shx lie together."""
    return all(stores.exists(_beside(path, s)) for s in (".shp", ".dbf", ".shx"))


def shp_rings(raw: bytes) -> Iterator[list[tuple[float, float]] | None]:
    """Outer ring (the first part) of polygons, single points as one-point rings; null shapes are none.  raw: records."""
    at = 0
    while at + 8 <= len(raw):
        size = struct.unpack_from(">i", raw, at + 4)[0] * 2
        body = at + 8
        kind = struct.unpack_from("<i", raw, body)[0]
        if kind == 0:
            yield None
        elif kind in (1, 11, 21):
            yield [struct.unpack_from("<2d", raw, body + 4)]
        elif kind in (3, 5, 13, 15, 23, 25):
            parts, points = struct.unpack_from("<2i", raw, body + 36)
            starts = [*struct.unpack_from(f"<{parts}i", raw, body + 44), points]
            flat = struct.unpack_from(f"<{2 * points}d", raw, body + 44 + 4 * parts)
            ring = list(zip(flat[::2], flat[1::2], strict=True))[starts[0] : starts[1]]
            yield ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring
        else:
            raise ValueError(f"shape type {kind} is not supported")
        at = body + size


def dbf_fields(raw: bytes) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """Rows, bytes of the header and of a row, and the fields: name, Spark type, place, length.  raw: the header."""
    count, header, size = struct.unpack_from("<IHH", raw, 4)
    fields, at, place = [], 32, 1
    while raw[at] != 0x0D:
        name = raw[at : at + 11].split(b"\0")[0].decode("latin-1")
        kind, length, places = chr(raw[at + 11]), raw[at + 16], raw[at + 17]
        fields.append((name, "double" if kind in "FN" and places or kind == "F" else "long" if kind == "N" else "string", place, length))
        place += length
        at += 32
    return count, header, size, fields


def dbf_rows(raw: bytes, size: int, fields: list[tuple[str, str, int, int]]) -> Iterator[tuple]:
    """The rows in raw; blank values are null."""
    for at in range(0, len(raw) - size + 1, size):
        text = [raw[at + p : at + p + n].decode("utf-8", "replace").strip() for _, _, p, n in fields]
        yield tuple(None if t in ("", "*" * len(t)) else float(t) if k == "double" else int(t) if k == "long" else t for t, (_, k, _, _) in zip(text, fields, strict=True))


def _dbf_header(path: str) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    at = _beside(path, ".dbf")
    return dbf_fields(stores.read_at(at, 0, struct.unpack("<H", stores.read_at(at, 8, 2))[0]))


class _ShapeReader(DataSourceReader):
    def __init__(self, path: str, batch: int):
        self.path, self.batch = path, batch

    def partitions(self) -> list[InputPartition]:
        return _cut(0, (stores.size_of(_beside(self.path, ".shx")) - 100) // 8, self.batch)

    def read(self, part: InputPartition) -> Iterator[tuple]:
        if not part.count:
            return
        _, header, size, fields = _dbf_header(self.path)
        index = struct.unpack(f">{2 * part.count}i", stores.read_at(_beside(self.path, ".shx"), 100 + 8 * part.first, 8 * part.count))
        begin, end = 2 * index[0], 2 * (index[-2] + index[-1]) + 8  # in words of two bytes; a record has a head of eight
        rings = shp_rings(stores.read_at(self.path, begin, end - begin))
        rows = dbf_rows(stores.read_at(_beside(self.path, ".dbf"), header + part.first * size, part.count * size), size, fields)
        for row, ring in zip(rows, rings, strict=True):
            yield (*row, ring)


class ShapeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> StructType:
        kinds = {"double": DoubleType(), "long": LongType(), "string": StringType()}
        return StructType([*(StructField(n, kinds[k]) for n, k, _, _ in _dbf_header(self.options["path"])[3]), StructField("ring", RING)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ShapeReader(self.options["path"], int(self.options.get("records", BATCH)))


def read_shapefile(spark: SparkSession, path: str, records: int = BATCH) -> DataFrame:
    """SC-06: attributes and ring."""
    if not shapefile_complete(path):
        raise FileNotFoundError(f"{path} lacks its .dbf or .shx")
    spark.dataSource.register(ShapeSource)
    return spark.read.format("shapefile").option("records", records).load(path)


def gpkg_ring(blob: bytes | None) -> list[tuple[float, float]] | None:
    """The outer ring of a GeoPackage geometry (polygon, or the first of several), or the point."""
    if blob is None:
        return None
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    envelope = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    return wkb_ring(blob[8 + envelope :])


def wkb_ring(raw: bytes) -> list[tuple[float, float]] | None:
    """GE-18: outer ring of a WKB polygon or multipolygon, or a point; empty geometries are none."""
    order = "<" if raw[0] else ">"
    kind = struct.unpack_from(f"{order}I", raw, 1)[0]
    width = 2 + (1 if kind // 1000 in (1, 2) or kind & 0x80000000 else 0) + (2 if kind // 1000 == 3 else 0)
    base = kind % 1000 if kind < 0x80000000 else kind & 0xFF
    if base == 1:
        return [struct.unpack_from(f"{order}2d", raw, 5)]
    count = struct.unpack_from(f"{order}I", raw, 5)[0]
    if not count:
        return None
    if base in (6, 7):
        return wkb_ring(raw[9:])
    if base != 3:
        raise ValueError(f"geometry type {base} is not supported")
    points = struct.unpack_from(f"{order}I", raw, 9)[0]
    flat = struct.unpack_from(f"{order}{points * width}d", raw, 13)
    ring = [tuple(flat[i : i + 2]) for i in range(0, len(flat), width)]
    return ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring


def ring_wkb(ring) -> bytes | None:
    """SK-05: a ring as a WKB polygon."""
    if not ring:
        return None
    points = [(p["x"], p["y"]) if not isinstance(p, tuple) else p for p in ring]
    points = [*points, points[0]]
    return struct.pack("<BIII", 1, 3, 1, len(points)) + b"".join(struct.pack("<2d", *p) for p in points)


def gpkg_layers(path: str) -> list[str]:
    with _open(path) as db:
        return [r[0] for r in db.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY table_name")]


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path.removeprefix('file:')}?mode=ro", uri=True)


def _gpkg_columns(path: str, layer: str) -> tuple[str, StructType]:
    with _open(path) as db:
        geom = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()[0]
        info = db.execute(f'PRAGMA table_info("{layer}")').fetchall()
    kind = lambda t: LongType() if "INT" in t.upper() else DoubleType() if t.upper() in ("REAL", "DOUBLE", "FLOAT") else StringType()
    return geom, StructType([*(StructField(r[1], kind(r[2])) for r in info if r[1] != geom), StructField("ring", RING)])


class _PackageReader(DataSourceReader):
    def __init__(self, path: str, layer: str, batch: int):
        self.path, self.layer, self.batch = path, layer, batch

    def partitions(self) -> list[InputPartition]:
        with _open(self.path) as db:
            first, last = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
        return _cut(first or 0, 0 if first is None else last - first + 1, self.batch)

    def read(self, part: InputPartition) -> Iterator[tuple]:
        geom, schema = _gpkg_columns(self.path, self.layer)
        fields = schema.fields[:-1]
        columns = ", ".join(f'"{f.name}"' for f in fields)
        with _open(self.path) as db:
            for *row, blob in db.execute(f'SELECT {columns}, "{geom}" FROM "{self.layer}" WHERE rowid >= ? AND rowid < ?', (part.first, part.first + part.count)):
                yield (*(str(v) if v is not None and isinstance(f.dataType, StringType) else v for v, f in zip(row, fields, strict=True)), gpkg_ring(blob))


class PackageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _layer(self) -> str:
        return self.options.get("layer") or gpkg_layers(self.options["path"])[0]

    def schema(self) -> StructType:
        return _gpkg_columns(self.options["path"], self._layer())[1]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PackageReader(self.options["path"], self._layer(), int(self.options.get("records", BATCH)))


def read_geopackage(spark: SparkSession, path: str, layer: str | None = None, records: int = BATCH) -> DataFrame:
    """SC-05: attributes and ring of one layer, the first if none is named."""
    spark.dataSource.register(PackageSource)
    reader = spark.read.format("geopackage").option("records", records)
    return (reader.option("layer", layer) if layer else reader).load(path)


def convert(spark: SparkSession, path: str, to: str, layer: str | None = None) -> None:
    """SK-01: a layer as Parquet."""
    read_geopackage(spark, path, layer).write.mode("overwrite").parquet(to)
