"""LAS point clouds as a Spark data source: one partition a file and range of points.

Uncompressed files of point formats 0 to 3 and 6 to 8 (LAS 1.2 to 1.4).  Absent dimensions are null.  flags has bit 0 for
synthetic points, 1 for key points, 2 for withheld ones, 3 for the scan direction and 4 for the edge of a flight line.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from . import files, stores

SCHEMA = "tile_id string, point_id bigint, x double, y double, z double, intensity int, classification int, number_of_returns int, scan_angle float, gps_time double, red int, green int, blue int, return_number int, flags int, user_data int, point_source int"
POINTS = 1 << 20


@dataclass(frozen=True)
class Header:
    offset: int
    form: int
    length: int
    count: int
    scale: tuple[float, float, float]
    shift: tuple[float, float, float]
    box: tuple[float, ...]


def read_header(raw: bytes) -> Header:
    """SC-08: the public header block."""
    if raw[:4] != b"LASF":
        raise ValueError("not a LAS file")
    minor = raw[25]
    offset, _, form, length, count = struct.unpack_from("<IIBHI", raw, 96)
    if form & 0x80:
        raise ValueError("compressed points (LAZ) need a codec")
    if minor >= 4:
        count = struct.unpack_from("<Q", raw, 247)[0] or count
    values = struct.unpack_from("<12d", raw, 131)
    return Header(offset, form, length, count, values[:3], values[3:6], values[6:])


def point_type(form: int, length: int) -> np.dtype:
    old = form < 6
    fields = [("X", "<i4"), ("Y", "<i4"), ("Z", "<i4"), ("intensity", "<u2")]
    fields += [("bits", "u1"), ("class", "u1"), ("angle", "i1"), ("user", "u1"), ("source", "<u2")] if old else [("bits", "u1"), ("flags", "u1"), ("class", "u1"), ("user", "u1"), ("angle", "<i2"), ("source", "<u2"), ("gps", "<f8")]
    if form in (1, 3):
        fields.append(("gps", "<f8"))
    if form in (2, 3, 7, 8):
        fields += [("red", "<u2"), ("green", "<u2"), ("blue", "<u2")]
    size = np.dtype(fields).itemsize
    if form not in (0, 1, 2, 3, 6, 7, 8) or length < size:
        raise ValueError(f"point format {form} of {length} bytes is not supported")
    return np.dtype(fields + ([("rest", f"V{length - size}")] if length > size else []))


def decode_points(raw: bytes, header: Header, tile: str, first: int) -> pa.RecordBatch:
    p = np.frombuffer(raw, dtype=point_type(header.form, header.length))
    n, old, names = len(p), header.form < 6, p.dtype.names
    column = lambda name, kind: pa.array(p[name].astype(kind)) if name in names else pa.nulls(n, pa.from_numpy_dtype(np.dtype(kind)))
    returns = (p["bits"] >> 3 & 7) if old else p["bits"] >> 4
    angle = p["angle"].astype(np.float32) * (1.0 if old else 0.006)
    xyz = [pa.array(p[c].astype(np.float64) * s + t) for c, s, t in zip("XYZ", header.scale, header.shift, strict=True)]
    kind = p["class"] & 31 if old else p["class"]
    number = p["bits"] & (7 if old else 15)
    flags = (p["class"] >> 5) | (p["bits"] >> 6) << 3 if old else (p["flags"] & 7) | (p["flags"] >> 6) << 3
    arrays = [pa.array([tile] * n, pa.string()), pa.array(np.arange(first, first + n)), *xyz, column("intensity", np.int32), pa.array(kind.astype(np.int32)), pa.array(returns.astype(np.int32)), pa.array(angle.astype(np.float32)), column("gps", np.float64), *(column(c, np.int32) for c in ("red", "green", "blue")), *(pa.array(v.astype(np.int32)) for v in (number, flags)), *(column(c, np.int32) for c in ("user", "source"))]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in SCHEMA.split(", ")])


class _Range(InputPartition):
    def __init__(self, path: str, first: int, count: int):
        self.path, self.first, self.count = path, first, count


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.points = options["path"], int(options.get("points", POINTS))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in stores.files_below(self.folder, ".las"):
            count = read_header(stores.read_at(path, 0, 375)).count
            out += [_Range(path, a, min(self.points, count - a)) for a in range(0, count, self.points)]
        return out or [_Range("", 0, 0)]

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        if not part.count:
            return
        store, at = stores.opened(part.path)
        with store.open_input_file(at) as f:
            header = read_header(f.read_at(min(375, f.size()), 0))
            for a in range(part.first, part.first + part.count, 65_536):
                n = min(65_536, part.first + part.count - a)
                yield decode_points(f.read_at(n * header.length, header.offset + a * header.length), header, Path(part.path).stem, a)


class LasSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def from_binary(files):
    """Points of a binaryFile scan, for stores that only Spark can open: path, content -> points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                header = read_header(raw)
                body = raw[header.offset : header.offset + header.count * header.length]
                step = 65_536 * header.length
                for a in range(0, len(body), step):
                    yield decode_points(body[a : a + step], header, Path(path).stem, a // header.length)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


#: Point formats 1 (with time) and 3 (with colour too), and the length of their records and of the header.
PLAIN, COLOURED, HEADER = 1, 3, 227
LENGTHS = {PLAIN: 28, COLOURED: 34}
SCALE = 0.001
#: Columns of a point file besides x, y and z, their greatest value, and what stands for a missing one.
DIMENSIONS = {"intensity": (65_535, 0), "classification": (31, 0), "number_of_returns": (7, 1), "return_number": (7, 1), "flags": (31, 0), "user_data": (255, 0), "point_source": (65_535, 0), "red": (65_535, 0), "green": (65_535, 0), "blue": (65_535, 0)}


def encode_points(columns: dict[str, np.ndarray], shift: tuple[float, float, float], form: int) -> bytes:
    """Records of a point format; columns beyond x, y and z may be missing.  Values that a record cannot hold are an error."""
    n = len(columns["x"])
    out = np.zeros(n, dtype=point_type(form, LENGTHS[form]))
    for name, low in zip("XYZ", shift, strict=True):
        whole = np.rint((columns[name.lower()] - low) / SCALE)
        if not (np.abs(whole) < 1 << 31).all():
            raise ValueError(f"{name.lower()} is missing or beyond what a file can hold")
        out[name] = whole
    v = {}
    for name, (most, none) in DIMENSIONS.items():
        got = columns.get(name)
        v[name] = np.full(n, none) if got is None else np.where(np.isnan(got.astype(float)), none, got).astype(np.int64)
        if ((v[name] < 0) | (v[name] > most)).any():
            raise ValueError(f"{name} is beyond what a record holds")
    out["intensity"], out["user"], out["source"] = v["intensity"], v["user_data"], v["point_source"]
    out["class"] = v["classification"] | (v["flags"] & 7) << 5
    out["bits"] = v["return_number"] | v["number_of_returns"] << 3 | (v["flags"] >> 3) << 6
    out["angle"] = np.clip(np.rint(np.nan_to_num(columns.get("scan_angle", np.zeros(n)).astype(float))), -90, 90)
    out["gps"] = np.nan_to_num(columns.get("gps_time", np.zeros(n)).astype(float))
    if form == COLOURED:
        for c in ("red", "green", "blue"):
            out[c] = v[c]
    return out.tobytes()


def encode_header(count: int, low: tuple[float, ...], high: tuple[float, ...], form: int, by_return: tuple[int, ...] = (0,) * 5) -> bytes:
    """SK-10: the header of a LAS 1.2 file: scale 0.001, offsets at the least coordinates."""
    head = bytearray(HEADER)
    head[:4], head[24], head[25] = b"LASF", 1, 2
    struct.pack_into("<HIIBHI5I", head, 94, HEADER, HEADER, 0, form, LENGTHS[form], count, *by_return)
    box = [v for pair in zip(high, low, strict=True) for v in pair]
    struct.pack_into("<12d", head, 131, SCALE, SCALE, SCALE, *np.floor(low), *box)
    return bytes(head)


def write_las(points, folder: str, key: str, order: tuple[str, ...] = (), replace: bool = False) -> None:
    """SK-10: KEY.las for each key that is not null, in a folder of any store, through a writer that commits.

    All that a file of format 1 holds is kept where points have the column: intensity, class, return and number of returns,
    angle (whole degrees), flags, user data, source and time; with red, green and blue it is format 3.  Dimensions of
    other names are left out.  Points are encoded in ranges of (key, order), so a large file is encoded by many tasks.
    """
    own = points.where(F.col(key).isNotNull())
    form = COLOURED if {"red", "green", "blue"} <= set(points.columns) else PLAIN
    names = [c for c in ("x", "y", "z", *DIMENSIONS, "scan_angle", "gps_time") if c in points.columns]
    first = F.coalesce(F.col("return_number"), F.lit(1)) if "return_number" in points.columns else F.lit(1)
    box = [f(c).cast("double").alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in "xyz"]
    sizes = own.groupBy(F.col(key).cast("string").alias("__key")).agg(F.count("*").alias("n"), *box, *(F.count_if(first == r).alias(f"r{r}") for r in range(1, 6)))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            raw = [encode_header(r["n"], tuple(r[f"min_{c}"] for c in "xyz"), tuple(r[f"max_{c}"] for c in "xyz"), form, tuple(r[f"r{i}"] for i in range(1, 6))) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([f"{r['__key']}.las" for r in rows], pa.string()), pa.array([-1] * len(rows), pa.int64()), pa.array(raw, pa.binary())], names=["name", "seq", "content"])

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("__key")
            edges = [0, *(np.flatnonzero(np.asarray(pc.not_equal(keys[1:], keys[:-1]))) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                shift = tuple(float(np.floor(part.column(f"min_{c}")[0].as_py())) for c in "xyz")
                raw = encode_points({c: part.column(c).to_numpy(zero_copy_only=False) for c in names}, shift, form)
                yield pa.RecordBatch.from_arrays([pa.array([f"{part.column('__key')[0].as_py()}.las"]), pa.array([(part.column("__part")[0].as_py() << 32) + at], pa.int64()), pa.array([raw], pa.binary())], names=["name", "seq", "content"])
                at += 1

    numbered = own.select(F.col(key).cast("string").alias("__key"), *names, *(c for c in order if c not in names)).join(sizes.select("__key", *(f"min_{c}" for c in "xyz")), "__key")
    dealt = numbered.repartitionByRange("__key", *order).sortWithinPartitions("__key", *order).withColumn("__part", F.spark_partition_id().cast("long"))
    files.write_pieces(sizes.mapInArrow(heads, files.PIECES).unionByName(dealt.mapInArrow(bodies, files.PIECES)), folder, replace)
