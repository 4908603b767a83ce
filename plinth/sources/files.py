"""Files that are not tables, written by a data source that commits.

A row is a piece of a file: (name, seq, content).  A task streams the pieces of its files, in order, into a staging folder
of its own; only when all tasks are done does the driver move the files to their names.  A task that fails or runs
twice leaves nothing but staging files that nobody reads, and they are deleted; so no file is seen before the commit,
and none is seen in part.  A file is written by one task, a piece at a time, whatever its size.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from . import stores

PIECES = "name string, seq bigint, content binary"
STAGING = "_staging-"


@dataclass
class Staged(WriterCommitMessage):
    """Where a task has put each of its files."""

    files: dict[str, str] = field(default_factory=dict)


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, replace: bool):
        self.folder, self.replace = folder.rstrip("/"), replace
        self.staging = f"{self.folder}/{STAGING}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        own, told, name, sink = f"{self.staging}/{uuid.uuid4().hex}", Staged(), None, None
        try:
            for batch in iterator:
                for n, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                    if n != name:
                        if n in told.files:
                            raise ValueError(f"the pieces of {n} do not lie together")
                        if sink is not None:
                            sink.close()
                        name, told.files[n] = n, f"{own}/{len(told.files)}"
                        sink = stores.sink(told.files[n])
                    sink.write(content.as_buffer() if content.is_valid else b"")
        finally:
            if sink is not None:
                sink.close()
        return told

    def commit(self, messages: list[Staged | None]) -> None:
        found: dict[str, str] = {}
        for told in messages:
            for name, at in (told.files if told else {}).items():
                if name in found:
                    raise ValueError(f"{name} was written by two tasks")
                if not self.replace and stores.exists(f"{self.folder}/{name}"):
                    raise FileExistsError(f"{self.folder}/{name}")
                found[name] = at
        for name, at in found.items():
            stores.move(at, f"{self.folder}/{name}")
        stores.delete_folder(self.staging)

    def abort(self, messages: list[Staged | None]) -> None:
        stores.delete_folder(self.staging)


class FileSink(DataSource):
    """Format "pieces": mode append refuses names that are there, overwrite replaces those it writes and leaves others."""

    @classmethod
    def name(cls) -> str:
        return "pieces"

    def schema(self) -> str:
        return PIECES

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def write_pieces(pieces: DataFrame, folder: str, replace: bool = False) -> None:
    """pieces: name (may have folders), seq, content.  Pieces of a file meet in one task and are written in order of seq."""
    pieces.sparkSession.dataSource.register(FileSink)
    dealt = pieces.select("name", F.col("seq").cast("long").alias("seq"), F.col("content").cast("binary").alias("content"))
    dealt = dealt.repartition("name").sortWithinPartitions("name", "seq")
    dealt.write.format("pieces").mode("overwrite" if replace else "append").save(folder)


def write_lines(lines: DataFrame, folder: str, name: Column, line: Column, order: Sequence[Column] = (), replace: bool = False) -> None:
    """Text files of a line a row, in order."""
    rows = lines.select(name.alias("name"), F.concat(line, F.lit("\n")).cast("binary").alias("content"), *(c.alias(f"o{i}") for i, c in enumerate(order)))
    keys = [f"o{i}" for i in range(len(order))]
    lines.sparkSession.dataSource.register(FileSink)
    dealt = rows.repartition("name").sortWithinPartitions("name", *keys).select("name", F.lit(0).cast("long").alias("seq"), "content")
    dealt.write.format("pieces").mode("overwrite" if replace else "append").save(folder)


def write_yolo(boxes: DataFrame, folder: str, image: str, classes: Sequence[str], splits: Mapping[str, float], seed: int = 7, replace: bool = False) -> DataFrame:
    """SK-15: labels/SPLIT/IMAGE.txt of boxes (image, class_id, line; views.yolo_lines) and data.yaml; returns image, split.

    An image's split goes by a hash of its name: the shares of splits hold on average, and no image changes sides when others
    come.  An image whose boxes have no known class has an empty file.
    """
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(image)), F.lit(1 << 30)) / float(1 << 30)
    named, parts = list(splits), list(splits.values())
    split = F.lit(named[-1])
    for i in range(len(named) - 2, -1, -1):
        split = F.when(share < sum(parts[: i + 1]) / sum(parts), named[i]).otherwise(split)
    stem = F.regexp_replace(F.col(image), r"\.[^./]*$", "")
    rows = boxes.withColumn("__split", split)
    body = F.when(F.col("class_id") >= 0, F.concat("line", F.lit("\n"))).otherwise("")
    pieces = rows.select(F.concat_ws("/", F.lit("labels"), "__split", F.concat(stem, F.lit(".txt"))).alias("name"), F.row_number().over(Window.partitionBy(image).orderBy("line")).alias("seq"), body.alias("content"))
    text = "\n".join([f"{s}: images/{s}" for s in splits] + [f"nc: {len(classes)}", f"names: {json.dumps(list(classes))}", ""])
    head = boxes.sparkSession.createDataFrame([("data.yaml", 0, text)], "name string, seq long, content string")
    write_pieces(pieces.unionByName(head), folder, replace)
    return rows.select(image, F.col("__split").alias("split")).distinct()


@dataclass(frozen=True)
class Grid:
    """SK-12/13: a raster's size and place: the outer corner of pixel (0, 0), pixel size, and the code of its projection."""

    width: int
    height: int
    x0: float = 0.0
    y0: float = 0.0
    pixel: float = 1.0
    epsg: int | None = None
    nodata: float = 9999.0
    side: int = 256

    @property
    def across(self) -> int:
        return -(-self.width // self.side)

    @property
    def down(self) -> int:
        return -(-self.height // self.side)

    def header(self) -> bytes:
        """The directory of a tiled file of 32-bit floats.  Tiles are not compressed, so their places are known.

        Files beyond 4 GB take 64-bit offsets.
        """
        tiles, size = self.across * self.down, self.side * self.side * 4
        big = tiles * (size + 16) + (1 << 20) >= 1 << 32
        place = "Q" if big else "I"
        geo = [(1024, 0, 1, 1 if self.epsg is None or self.epsg != 4326 else 2), (1025, 0, 1, 1)]
        geo += [] if self.epsg is None else [(2048 if self.epsg == 4326 else 3072, 0, 1, self.epsg)]
        keys = [1, 1, 0, len(geo), *(v for k in geo for v in k)]
        bare = f"{self.nodata:g}".encode() + b"\0"
        kinds = {"H": 3, "I": 4, "d": 12, "s": 2, "Q": 16}
        tags = [(256, "I", [self.width]), (257, "I", [self.height]), (258, "H", [32]), (259, "H", [1]), (262, "H", [1]), (277, "H", [1]), (322, "I", [self.side]), (323, "I", [self.side]), (324, place, [0] * tiles), (325, "I", [size] * tiles), (339, "H", [3]), (33550, "d", [self.pixel, self.pixel, 0.0]), (33922, "d", [0.0, 0.0, 0.0, self.x0, self.y0, 0.0]), (34735, "H", keys), (42113, "s", [bare])]
        entry, room = (20, 8) if big else (12, 4)
        start = 16 if big else 8
        after = start + (8 if big else 2) + entry * len(tags) + (8 if big else 4)
        raw = {t: v[0] if k == "s" else struct.pack(f"<{len(v)}{k}", *v) for t, k, v in tags}
        end = after + sum(len(r) for r in raw.values() if len(r) > room)
        raw[324] = struct.pack(f"<{tiles}{place}", *(end + size * i for i in range(tiles)))
        out, extra = bytearray(), bytearray()
        for t, k, v in tags:
            n = len(raw[t]) if k == "s" else len(v)
            held = raw[t].ljust(room, b"\0") if len(raw[t]) <= room else struct.pack("<Q" if big else "<I", after + len(extra))
            extra += b"" if len(raw[t]) <= room else raw[t]
            out += struct.pack("<HHQ" if big else "<HHI", t, kinds[k], n) + held
        head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, start) if big else struct.pack("<2sHI", b"II", 42, start)
        return head + struct.pack("<Q" if big else "<H", len(tags)) + bytes(out) + bytes(8 if big else 4) + bytes(extra)


def write_geotiff(pixels: DataFrame, folder: str, key: str, grid: Grid, value: str = "value", replace: bool = False) -> None:
    """SK-12/13: KEY.tif of each raster's pixels (key, u, v, value): a tile a task, missing pixels without data.

    Pixels outside the grid are left out; two values of one pixel are an error of the caller, the greater one stays.
    """
    side, cells = grid.side, grid.across * grid.down
    inside = pixels.where(F.col("u").between(0, grid.width - 1) & F.col("v").between(0, grid.height - 1) & F.col(key).isNotNull())
    at = inside.select(F.col(key).cast("string").alias("key"), (F.floor(F.col("v") / side) * grid.across + F.floor(F.col("u") / side)).cast("long").alias("seq"), ((F.col("v") % side) * side + F.col("u") % side).cast("int").alias("at"), F.col(value).cast("float").alias("value"))
    held = at.groupBy("key", "seq").agg(F.collect_list(F.struct("at", "value")).alias("held"))  # a tile's pixels at most
    every = at.select("key").distinct().select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("seq"))
    tiles = every.join(held, ["key", "seq"], "left")

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tile = np.full(side * side, grid.nodata, dtype="<f4")
                own = batch.column(2)[row]
                if own.is_valid:
                    place, v = (own.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    by = np.argsort(v, kind="stable")
                    tile[place[by]] = v[by]
                yield pa.RecordBatch.from_arrays([pa.array([f"{batch.column(0)[row].as_py()}.tif"]), batch.column(1).slice(row, 1), pa.array([tile.tobytes()], pa.binary())], names=["name", "seq", "content"])

    heads = at.select("key").distinct().select(F.concat("key", F.lit(".tif")).alias("name"), F.lit(-1).cast("long").alias("seq"), F.lit(bytearray(grid.header())).alias("content"))
    write_pieces(tiles.mapInArrow(drawn, PIECES).unionByName(heads), folder, replace)


def read_geotiff(raw: bytes) -> tuple[np.ndarray, dict[int, tuple]]:
    """The pixels and the tags of a tiled file of 32-bit floats, as write_geotiff makes them."""
    big = struct.unpack_from("<H", raw, 2)[0] == 43
    at = struct.unpack_from("<Q" if big else "<I", raw, 8 if big else 4)[0]
    n, at = (struct.unpack_from("<Q", raw, at)[0], at + 8) if big else (struct.unpack_from("<H", raw, at)[0], at + 2)
    tags = {}
    for i in range(n):
        t, kind, count = struct.unpack_from("<HHQ" if big else "<HHI", raw, at + i * (20 if big else 12))
        form = {2: "s", 3: "H", 4: "I", 12: "d", 16: "Q"}[kind]
        form = f"<{count}{form}"
        place = at + i * (20 if big else 12) + (12 if big else 8)
        if struct.calcsize(form) > (8 if big else 4):
            place = struct.unpack_from("<Q" if big else "<I", raw, place)[0]
        tags[t] = struct.unpack_from(form, raw, place)
    if tags[259] != (1,) or tags[339] != (3,) or tags[258] != (32,):
        raise ValueError("only 32-bit floats without compression are read")
    width, height, side = tags[256][0], tags[257][0], tags[322][0]
    across = -(-width // side)
    out = np.empty((-(-height // side) * side, across * side), dtype=np.float32)
    for i, (place, size) in enumerate(zip(tags[324], tags[325], strict=True)):
        r, c = divmod(i, across)
        out[r * side : (r + 1) * side, c * side : (c + 1) * side] = np.frombuffer(raw, dtype="<f4", count=size // 4, offset=place).reshape(side, side)
    return out[:height, :width], tags


def write_geoparquet(df: DataFrame, folder: str, geometry: str = "geometry", crs: Mapping | None = None, rows: int = 1 << 18, replace: bool = False) -> None:
    """SK-05: Parquet files with the geo footer: a WKB column of polygons, with the box of each file.

    A file holds up to so many rows, which are what a task holds.  crs is a PROJJSON object, or null: not known.
    """
    names = df.columns

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def told() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            column = {"encoding": "WKB", "geometry_types": ["Polygon"], "crs": crs}
            boxes = [_box(g) for g in table[geometry].to_pylist() if g is not None]
            if boxes:
                column["bbox"] = [float(f([b[i] for b in boxes])) for i, f in enumerate((min, min, max, max))]
            geo = {"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column}}
            sink = pa.BufferOutputStream()
            pq.write_table(table.replace_schema_metadata({b"geo": json.dumps(geo).encode()}), sink)
            return pa.RecordBatch.from_arrays([pa.array([f"part-{uuid.uuid4().hex}.parquet"]), pa.array([0], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["name", "seq", "content"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield told()
                held, n = [], 0
        if n:
            yield told()

    write_pieces(df.select(*names).mapInArrow(encoded, PIECES), folder, replace)


def _box(wkb: bytes) -> tuple[float, float, float, float]:
    """Of a polygon with one ring."""
    n = struct.unpack_from("<I", wkb, 9)[0]
    xy = np.frombuffer(wkb, dtype="<f8", count=2 * n, offset=13).reshape(-1, 2)
    return (*xy.min(axis=0), *xy.max(axis=0))
