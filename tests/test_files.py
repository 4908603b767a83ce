from __future__ import annotations

import json
import struct
import subprocess
import sys

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plinth.operators import views
from plinth.sources import files, las
from plinth.sources.shapes import ring_wkb, wkb_ring

from .conftest import ROOT


def names(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_points_keep_all_that_a_file_holds(spark, tmp_path):
    rng = np.random.default_rng(6)
    n = 5000
    rows = [
        (int(i % 3), int(i), *(round(float(v), 3) for v in rng.uniform((3e5, 6e6, -5), (3e5 + 500, 6e6 + 500, 60))), int(rng.integers(0, 65536)), int(rng.integers(0, 32)), int(rng.integers(1, 8)), int(rng.integers(1, 8)), int(rng.integers(0, 32)), int(rng.integers(0, 256)), int(rng.integers(0, 65536)), float(rng.integers(-90, 91)), float(rng.uniform(0, 1e6)), *(int(v) for v in rng.integers(0, 65536, 3)))
        for i in range(n)
    ]
    columns = "clip long, point_id long, x double, y double, z double, intensity int, classification int, number_of_returns int, return_number int, flags int, user_data int, point_source int, scan_angle double, gps_time double, red int, green int, blue int"
    p = spark.createDataFrame(rows, columns).repartition(7)
    las.write_las(p.unionByName(p.limit(1).withColumn("clip", F.lit(None).cast("long"))), str(tmp_path), "clip", ("point_id",))
    assert names(tmp_path) == ["0.las", "1.las", "2.las"]
    spark.dataSource.register(las.LasSource)
    got = spark.read.format("las").load(str(tmp_path)).orderBy("tile_id", "point_id").collect()
    want = sorted(rows, key=lambda r: (r[0], r[1]))  # points lie in order of their ids
    assert len(got) == n
    fields = columns.replace(",", "").split()[::2]
    for g, w in zip(got, want, strict=True):
        told = dict(zip(fields, w, strict=True))
        assert g["tile_id"] == str(told["clip"]) and all(abs(g[c] - told[c]) < 1e-6 for c in "xyz")
        assert all(g[c] == told[c] for c in fields[5:])
    head = las.read_header((tmp_path / "1.las").read_bytes())
    own = [w for w in want if w[0] == 1]
    assert head.form == 3 and head.count == len(own) and head.box[0] == max(w[2] for w in own)
    assert struct.unpack_from("<5I", (tmp_path / "1.las").read_bytes(), 111) == tuple(sum(w[8] == r for w in own) for r in range(1, 6))


def test_plain_points_and_values_that_do_not_fit(spark, tmp_path):
    p = spark.createDataFrame([("a", float(i), 1.0, 2.0, i) for i in range(20)], "id string, x double, y double, z double, classification int")
    las.write_las(p, f"file://{tmp_path}/out", "id")
    spark.dataSource.register(las.LasSource)
    assert sorted(r["classification"] for r in spark.read.format("las").load(str(tmp_path / "out")).collect()) == list(range(20))
    with pytest.raises(Exception, match="beyond what a record holds"):
        las.write_las(p.withColumn("classification", F.lit(200)), str(tmp_path / "bad"), "id")
    assert not (tmp_path / "bad").exists() or names(tmp_path / "bad") == []


def test_nothing_is_seen_before_the_commit(spark, tmp_path):
    """One task fails: files of the others are not there, and names that are there are refused or replaced as a whole."""
    rows = spark.range(40).select(F.concat(F.lit("d/f"), F.col("id"), F.lit(".bin")).alias("name"), F.lit(0).alias("seq"), F.col("id").cast("string").alias("content"))
    broken = rows.withColumn("content", F.when(F.col("name") == "d/f7.bin", F.raise_error(F.lit("no"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="no"):
        files.write_pieces(broken, str(tmp_path))
    assert names(tmp_path) == []
    files.write_pieces(rows, str(tmp_path))
    assert names(tmp_path) == sorted(f"d/f{i}.bin" for i in range(40)) and (tmp_path / "d/f12.bin").read_text() == "12"
    with pytest.raises(Exception, match="FileExistsError|f3.bin"):
        files.write_pieces(rows.where("name = 'd/f3.bin'").unionByName(rows.limit(1).withColumn("name", F.lit("new"))), str(tmp_path))
    assert "new" not in names(tmp_path)
    files.write_pieces(rows.where("name = 'd/f3.bin'").withColumn("content", F.lit("again")), str(tmp_path), replace=True)
    assert (tmp_path / "d/f3.bin").read_text() == "again" and len(names(tmp_path)) == 40


AGAIN = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
import pyarrow as pa
from plinth.sources import files
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.adaptive.enabled", "false").getOrCreate()

def once(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            if i == 20 and TaskContext.get().attemptNumber() == 0:
                raise ValueError("the first attempt fails after some pieces")
            yield batch.slice(i, 1)

spark.dataSource.register(files.FileSink)
rows = spark.range(60).selectExpr("concat('f', id % 6) AS name", "id AS seq", "cast(concat(id, ',') AS binary) AS content").repartition("name").sortWithinPartitions("name", "seq")
rows.mapInArrow(once, files.PIECES).write.format("pieces").mode("append").save({folder!r})
"""


def test_a_task_that_fails_once_writes_its_files_once(tmp_path):
    run = subprocess.run([sys.executable, "-c", AGAIN.format(root=ROOT, folder=str(tmp_path / "out"))], capture_output=True, text=True, timeout=200)
    assert run.returncode == 0, run.stderr[-2000:]
    assert names(tmp_path / "out") == [f"f{i}" for i in range(6)]
    assert all((tmp_path / f"out/f{i}").read_text() == "".join(f"{k}," for k in range(i, 60, 6)) for i in range(6))


def test_geotiff(spark, tmp_path):
    grid = files.Grid(70, 45, 300_000.0, 6_000_045.0, 0.5, 28355, 9999.0, 32)
    rows = [(k, u, v, float(u * 100 + v) / 7) for k in ("a", "b") for u in range(-1, 71) for v in range(0, 46) if (u + v + len(k)) % 3 or u < 5]
    rows = [r for r in rows if not (r[0] == "b" and r[1] < 32 and r[2] < 32)]  # a tile without pixels
    df = spark.createDataFrame([*rows, (None, 1, 1, 1.0)], "key string, u int, v int, value double")
    files.write_geotiff(df, str(tmp_path), "key", grid)
    assert names(tmp_path) == ["a.tif", "b.tif"]
    for k in "ab":
        want = np.full((45, 70), 9999.0, dtype=np.float32)
        for key, u, v, value in rows:
            if key == k and 0 <= u < 70 and 0 <= v < 45:
                want[v, u] = value
        got, tags = files.read_geotiff((tmp_path / f"{k}.tif").read_bytes())
        assert np.array_equal(got, want)
        assert tags[33550] == (0.5, 0.5, 0.0) and tags[33922] == (0.0, 0.0, 0.0, 300_000.0, 6_000_045.0, 0.0)
        assert tags[42113][0] == b"9999\0" and tags[34735][-4:] == (3072, 0, 1, 28355) and tags[34735][3] == 3


def test_large_rasters_take_wide_offsets():
    grid = files.Grid(40_000, 40_000, side=512)
    head = grid.header()
    assert head[:4] == b"II" + struct.pack("<H", 43)
    n = struct.unpack_from("<Q", head, 16)[0]
    tags = {struct.unpack_from("<HHQQ", head, 24 + 20 * i)[0]: struct.unpack_from("<HHQQ", head, 24 + 20 * i)[1:] for i in range(n)}
    assert list(tags) == sorted(tags) and tags[256][2] == 40_000
    first, last = struct.unpack_from("<Q", head, tags[324][2])[0], struct.unpack_from("<Q", head, tags[324][2] + 8 * (tags[324][1] - 1))[0]
    assert tags[324][1] == 79 * 79 and first == len(head) and last == len(head) + (79 * 79 - 1) * 512 * 512 * 4 > 1 << 32


def test_geoparquet(spark, tmp_path):
    rings = {i: [(float(i), 0.0), (i + 2.0, 0.0), (i + 1.0, 3.0 + i)] for i in range(50)}
    df = spark.createDataFrame([(i, bytearray(ring_wkb(r))) for i, r in rings.items()] + [(99, None)], "id long, geometry binary").repartition(3)
    files.write_geoparquet(df, str(tmp_path), rows=10, crs={"type": "ProjectedCRS", "name": "x"})
    assert len(names(tmp_path)) >= 3
    seen = {}
    for name in names(tmp_path):
        table = pq.read_table(tmp_path / name)
        geo = json.loads(table.schema.metadata[b"geo"])
        own = {r["id"]: r["geometry"] for r in table.to_pylist()}
        column = geo["columns"][geo["primary_column"]]
        points = [p for g in own.values() if g for p in wkb_ring(g)]
        assert column["encoding"] == "WKB" and column["crs"]["name"] == "x"
        assert column["bbox"] == [min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points)]
        seen |= own
    assert {i: g and wkb_ring(g) for i, g in seen.items()} == rings | {99: None}
    assert spark.read.parquet(str(tmp_path)).count() == 51


def test_label_files(spark, tmp_path):
    rows = [(f"img{i}.jpg", c, 10.0 * k, 5.0, 10.0 * k + 8, 9.0) for i in range(200) for k, c in enumerate(["Front Door", "Window", "what"][: 1 + i % 3])] + [("odd.jpg", "what", 0.0, 0.0, 1.0, 1.0)]
    boxes = spark.createDataFrame(rows, "image string, class_name string, x1 double, y1 double, x2 double, y2 double")
    told = views.yolo_lines(boxes, F.lit(100.0), F.lit(50.0))
    out = files.write_yolo(told, str(tmp_path), "image", views.CLASSES, {"train": 0.7, "val": 0.2, "test": 0.1})
    split = {r["image"]: r["split"] for r in out.collect()}
    assert len(split) == 201 and 100 < sum(s == "train" for s in split.values()) < 180
    assert names(tmp_path) == sorted(["data.yaml", *(f"labels/{s}/{i[:-4]}.txt" for i, s in split.items())])
    want = {}
    for r in told.collect():
        want.setdefault(r["image"], []).extend([r["line"]] if r["class_id"] >= 0 else [])
    assert all((tmp_path / f"labels/{split[i]}/{i[:-4]}.txt").read_text().split("\n")[:-1] == sorted(x) for i, x in want.items())
    assert f"nc: {len(views.CLASSES)}" in (tmp_path / "data.yaml").read_text()


def test_lines(spark, tmp_path):
    df = spark.range(30).select((F.col("id") % 2).alias("k"), "id")
    files.write_lines(df, str(tmp_path), F.concat(F.lit("r"), F.col("k"), F.lit(".txt")), F.col("id").cast("string"), [F.col("id")])
    assert (tmp_path / "r1.txt").read_text() == "".join(f"{i}\n" for i in range(1, 30, 2))
