from __future__ import annotations

import hashlib
import json
import math
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.catalog import Catalog, file_hashes, file_index, limited, stamped, valid_files
from plinth.operators.models import detect, embed, readable
from plinth.plans import stages
from plinth.schemas import STAGE_SCHEMAS
from plinth.sources import las, shapes, tables
from plinth.streaming import incremental

from .test_kernels import RINGS, in_pieces


def test_las_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    x, y, z = rng.uniform(500_000, 500_100, 3000), rng.uniform(5_000_000, 5_000_100, 3000), rng.uniform(0, 30, 3000)
    kind, ret, gps = rng.integers(0, 8, 3000), rng.integers(1, 5, 3000), rng.uniform(0, 1e5, 3000)
    (tmp_path / "a").mkdir()
    low, high = tuple(float(v.min()) for v in (x, y, z)), tuple(float(v.max()) for v in (x, y, z))
    raw = las.encode_points({"x": x, "y": y, "z": z, "intensity": np.arange(3000), "classification": kind, "number_of_returns": ret, "gps_time": gps}, tuple(np.floor(low)), las.PLAIN)
    (tmp_path / "a" / "tile.las").write_bytes(las.encode_header(3000, low, high, las.PLAIN) + raw)
    spark.dataSource.register(las.LasSource)
    got = spark.read.format("las").option("points", 700).load(str(tmp_path)).orderBy("point_id").toPandas()
    assert len(got) == 3000 and got.tile_id.unique().tolist() == ["tile"]
    assert np.abs(got.x - x).max() <= 0.00051 and np.abs(got.z - z).max() <= 0.00051
    assert got.classification.tolist() == kind.tolist() and got.number_of_returns.tolist() == ret.tolist() and np.allclose(got.gps_time, gps) and got.red.isna().all()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    assert las.from_binary(files).agg(F.sum("point_id")).first()[0] == sum(range(3000))
    assert file_index(spark, str(tmp_path)).first()["stem"] == "tile"
    with pytest.raises(ValueError):
        las.read_header(b"nope" * 100)


def test_shapefile(spark, tmp_path):
    ring = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]
    body = struct.pack("<i4d2ii", 5, 0, 0, 2, 2, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    shp = bytes(100) + struct.pack(">2i", 1, len(body) // 2) + body + struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    field = lambda n, k, w, d: n.encode().ljust(11, b"\0") + k.encode() + bytes(4) + bytes([w, d]) + bytes(14)
    fields = field("FILENAME", "C", 8, 0) + field("N", "N", 4, 0) + field("V", "N", 6, 2)
    dbf = struct.pack("<4BIHH20x", 3, 0, 0, 0, 2, 32 + len(fields) + 1, 19) + fields + b"\r" + b" tile1   " + b"  12" + b"  1.50" + b" tile2   " + b"    " + b"      "
    shx = bytes(100) + struct.pack(">4i", 50, len(body) // 2, 54 + len(body) // 2, 2)
    for suffix, raw in ((".shp", shp), (".dbf", dbf), (".shx", shx)):
        (tmp_path / f"t{suffix}").write_bytes(raw)
    split = shapes.read_shapefile(spark, f"file://{tmp_path}/t.shp", records=1)
    assert split.rdd.getNumPartitions() == 2 and split.collect() == shapes.read_shapefile(spark, str(tmp_path / "t.shp")).collect()
    rows = split.collect()
    assert [(r["FILENAME"], r["N"], r["V"], r["ring"] and len(r["ring"])) for r in rows] == [("tile1", 12, 1.5, 4), ("tile2", None, None, None)]
    (tmp_path / "t.shx").unlink()
    with pytest.raises(FileNotFoundError):
        shapes.read_shapefile(spark, str(tmp_path / "t.shp"))


def test_geopackage(spark, tmp_path):
    path = str(tmp_path / "b.gpkg")
    ring = [(1.0, 1.0), (3.0, 1.0), (3.0, 2.0)]
    db = sqlite3.connect(path)
    db.executescript("CREATE TABLE gpkg_contents(table_name, data_type); CREATE TABLE gpkg_geometry_columns(table_name, column_name); CREATE TABLE b(id INTEGER, name TEXT, h REAL, geom BLOB); INSERT INTO gpkg_contents VALUES('b', 'features'); INSERT INTO gpkg_geometry_columns VALUES('b', 'geom')")
    blob = b"GP\0\x03" + struct.pack("<i4d", 7844, 1, 3, 1, 2) + shapes.ring_wkb(ring)
    db.executemany("INSERT INTO b VALUES(?, ?, ?, ?)", [(1, "x", 2.5, blob), (2, None, None, None)])
    db.commit()
    rows = shapes.read_geopackage(spark, path, records=1).orderBy("id").collect()
    assert [tuple(p) for p in rows[0]["ring"]] == ring and rows[1]["ring"] is None and rows[0]["h"] == 2.5
    shapes.convert(spark, path, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_text_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text("imgID,Latitude_deg,Longitude_deg,Heading_deg,Pitch_deg,Roll_deg,LTP_z_m\na_1-x.jpg,-41.4,147.1,10,0,0,5\n")
    assert tables.read_trajectory(spark, str(tmp_path / "t.csv")).first()["geometry"]["x"] == 147.1
    coco = {"images": [{"id": 1, "file_name": "a"}], "categories": [{"id": 9, "name": "Stairs"}, {"id": 4, "name": "Window"}], "annotations": [{"image_id": 1, "category_id": 9, "bbox": [1, 2, 3, 4]}]}
    (tmp_path / "c.json").write_text(json.dumps(coco))
    images, boxes = tables.read_coco(spark, str(tmp_path / "c.json"))
    assert images.count() == 1 and (boxes.first()["class_id"], boxes.first()["x2"]) == (1, 4.0)
    odd = spark.range(1).select(tables.polygon_line(F.array(*(F.lit(float(v)) for v in (1, 2, 3, 4, 5))), F.lit(10.0), F.lit(10.0)).alias("p")).first()["p"]
    assert [tuple(q) for q in odd] == [(0.1, 0.2), (0.3, 0.4)]
    assert tables.regions(spark).count() == 3


def test_catalog_and_files(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "cat"))
    assert c.table("stage01_clips").schema == STAGE_SCHEMAS["stage01_clips"] and len(STAGE_SCHEMAS["stage09a_lidar_stats"].fields) >= 60
    df = spark.createDataFrame([(1, None), (2, "g")], "id long, gnaf string")
    assert c.append(df, "t", ("id", "gnaf")) == 2 and c.append(df, "t", ("id", "gnaf")) == 0
    assert c.append(spark.createDataFrame([(3, None)], df.schema), "t", ("id", "gnaf")) == 1
    assert c.query("SELECT count(*) AS n FROM t", ["t"]).first()["n"] == 3
    c.export(["t"], str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/t")).count() == 3
    assert stamped(df).schema["processed_at"].dataType.simpleString() == "timestamp_ntz"
    many = spark.range(1000)
    assert limited(many, "id", 0.1).count() < 200 and limited(many, "id", limit=5).collect() == limited(many.repartition(7), "id", limit=5).collect()
    c.ensure("stage07_floor_heights")
    assert c.exists("stage07_floor_heights")
    c.drop("t")
    assert not c.exists("t")
    (tmp_path / "img").mkdir()
    (tmp_path / "img/a.jpg").write_bytes(bytes.fromhex("ffd8ffe0") + bytes(2000))
    (tmp_path / "img/b.jpg").write_bytes(b"bad")
    files = spark.read.format("binaryFile").load(str(tmp_path / "img"))
    assert {r["path"][-5:]: r["valid"] for r in valid_files(files, 1000, bytes.fromhex("ffd8ff")).collect()} == {"a.jpg": True, "b.jpg": False}
    told = {r["path"][-5:]: (r["length"], r["md5"], r["sha256"]) for r in file_hashes(files, 2).collect()}
    assert told["b.jpg"] == (3, hashlib.md5(b"bad").hexdigest(), hashlib.sha256(b"bad").hexdigest()) and len(told) == 2
    assert readable(files).count() == 1
    done = spark.createDataFrame([(1, str(tmp_path / "img/a.jpg")), (2, str(tmp_path / "img/gone.jpg"))], "id long, path string")
    assert [r["id"] for r in incremental.redo(done, files.select("path", "length"), "path").collect()] == [2]


def test_models_are_injected(spark):
    images = spark.createDataFrame([(i, bytes([i])) for i in range(7)], "id long, content binary")
    load = lambda: lambda batch: [[(b[0] % 6, 0.1 * b[0], 0.0, 0.0, 1.0, 1.0)] for b in batch]
    got = {r["id"]: r["class_name"] for r in detect(images, load, "id", 0.25, 2).collect()}
    assert got == {3: "Stairs", 4: "Window", 5: "Unknown-5", 6: "Front Door"}
    assert embed(images, lambda: lambda batch: [[float(b[0]), 1.0] for b in batch], "id").count() == 7


def test_stream_adds_each_key_once(spark, tmp_path):
    src, to = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: incremental.run_once(incremental.new_files(spark, src, "id long, v double"), lambda d: d.withColumn("w", F.col("v") * 2), to, str(tmp_path / "ck"), ["id"])
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, v double").write.parquet(src)
    run()
    spark.createDataFrame([(2, 9.0), (3, 3.0)], "id long, v double").write.mode("append").parquet(src)
    run()
    assert {r["id"]: r["w"] for r in spark.read.parquet(to).collect()} == {1: 2.0, 2: 4.0, 3: 6.0}


def test_stages_run_in_order_and_resume(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "c"))
    assert [d.name for d in stages.resolve(["clip", "9a", "stage01", "1"])] == ["stage01", "stage09a"]
    with pytest.raises(FileNotFoundError):
        stages.run(c, ["clip"])
    square = lambda x: f"POLYGON (({x} 0, {x + 10} 0, {x + 10} 10, {x} 10, {x} 0))"
    c.overwrite(spark.createDataFrame([(1, "b1", "wagga", square(0)), (2, "b2", "tweed", square(100))], "id long, building_id string, region_name string, footprint_wkt string"), "buildings")
    c.overwrite(spark.createDataFrame([("t", i, float(i % 120), float(i % 7), float(i % 5), 10, 1 + i % 7, 1 + i % 2, float(i)) for i in range(2400)], "tile_id string, point_id long, x double, y double, z double, intensity int, classification int, number_of_returns int, gps_time double"), "points")
    assert stages.run(c, ["1"], region="wagga", to={"stage01": "clipped_points"})["stage01"] > 0
    assert {r["id"] for r in c.table("clipped_points").select("id").distinct().collect()} == {1}
    assert stages.run(c, ["1"], to={"stage01": "clipped_points"})["stage01"] > 0  # the other region now
    assert stages.run(c, ["6", "9a"]) == {"stage06": 2, "stage09a": 2}
    failed = {}
    assert stages.run(c, ["4b", "6", "9a"], failed=failed) == {"stage06": 0, "stage09a": 0}
    assert isinstance(failed["stage04b"], FileNotFoundError)


def test_clips_of_an_l_shaped_footprint(spark, tmp_path):
    """Stage 1 from tables to clip: simplified ring, mitred buffer, the region alone, against brute force."""
    c = Catalog(spark, str(tmp_path / "c"))
    ring = RINGS[1]
    near_straight = [ring[0], (6.0, 0.01), *ring[1:]]  # simplification takes this corner out
    shape = lambda r, dx: "POLYGON ((" + ", ".join(f"{x + dx} {y}" for x, y in [*r, r[0]]) + "))"
    rows = [(1, "b1", "wagga", shape(near_straight, 0.0)), (2, "b2", "tweed", shape(ring[::-1], 8.0))]
    c.overwrite(spark.createDataFrame(rows, "id long, building_id string, region_name string, footprint_wkt string"), "buildings")
    rng = np.random.default_rng(12)
    points = [("t", i, float(x), float(y), 1.0, "wagga" if i % 2 else "tweed") for i, (x, y) in enumerate(rng.uniform(-8, 30, (3000, 2)))]
    c.overwrite(spark.createDataFrame(points, "tile_id string, point_id long, x double, y double, z double, region_name string"), "points")
    got = {}
    for region in ("wagga", "tweed"):
        stages.run(c, ["1"], region=region, to={"stage01": f"clip_{region}"})
        got[region] = {(r["id"], r["point_id"]) for r in c.table(f"clip_{region}").collect()}
    for region, i, dx in (("wagga", 1, 0.0), ("tweed", 2, 8.0)):
        want = {(i, p[1]) for p in points if p[5] == region and in_pieces(ring, p[2] - dx, p[3], 5.0)}
        assert got[region] == want and want


def test_regions_prune_files(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "c"))
    c.ensure("stage07_floor_heights")
    assert c.table("stage07_floor_heights").count() == 0
    rows = [(i, f"b{i}", "wagga" if i % 2 else "tweed", None, 1.0, None, None, "m", None) for i in range(6)]
    assert c.append(spark.createDataFrame(rows, STAGE_SCHEMAS["stage07_floor_heights"]), "stage07_floor_heights") == 6
    found = c.scan("stage07_floor_heights", region="wagga")
    assert {r["id"] for r in found.collect()} == {1, 3, 5}
    assert "PartitionFilters: [isnotnull(region_name" in found._jdf.queryExecution().executedPlan().toString()


def test_views_are_found_and_downloads_named(spark, tmp_path):
    """Stages 2a and 2b: the camera in front of each side, and the first of its names that the store lists."""
    c = Catalog(spark, str(tmp_path / "c"))
    square = lambda x: f"POLYGON (({x} 0, {x + 10} 0, {x + 10} 10, {x} 10, {x} 0))"
    c.overwrite(spark.createDataFrame([(1, "b1", "wagga", square(0)), (2, "b2", "tweed", square(500))], "id long, building_id string, region_name string, footprint_wkt string"), "buildings")
    cameras = [("p_1-NoRoad.jpg", 5.0, -20.0, 0.0, "wagga"), ("p_2-x", 30.0, 5.0, 0.0, "wagga"), ("p_3-x", 505.0, -20.0, 0.0, "tweed")]
    c.overwrite(spark.createDataFrame(cameras, "pano_id string, x double, y double, heading double, region_name string"), "panoramas")
    c.overwrite(spark.createDataFrame([("p_1-OutsideAOI.jpg", "s/1"), ("p_1-NoRoad.jpg", "s/1b"), ("p_3-x.jpg", "s/3")], "name string, path string"), "pano_files")
    assert stages.run(c, ["2a"], region="wagga", to={"stage02a": "candidate_views"}) == {"stage02a": 2}
    assert {r["pano_id"] for r in c.table("candidate_views").collect()} == {"p_1-NoRoad.jpg", "p_2-x"}
    stages.run(c, ["2a"], to={"stage02a": "candidate_views"})
    to = {"stage02b": "downloads"}
    assert stages.run(c, ["2b"], region="wagga", to=to) == {"stage02b": 1} and stages.run(c, ["2b"], to=to) == {"stage02b": 1}
    assert {(r["id"], r["download_path"]) for r in c.table("downloads").collect()} == {(1, "s/1"), (2, "s/3")}
    # of each square the near corners are seen, 14.04 degrees to both sides, and a margin of a twentieth is added
    assert stages.run(c, ["3"], region="wagga") == {"stage03": 1} and stages.run(c, ["3"]) == {"stage03": 1}
    side = 5500 / 180 * math.degrees(math.atan(5 / 20))
    lo, hi = round(5500 - side), round(5500 + side)
    margin = int((hi - lo) * 0.05)
    assert {(r["id"], r["clip_left"], r["clip_right"], r["clip_top"], r["clip_bottom"]) for r in c.table("windows").collect()} == {(i, lo - margin, hi + margin, 1375, 3300) for i in (1, 2)}


def test_stages_read_what_stages_write(spark, tmp_path):
    """From footprints, points and given features to validated heights, no table named by hand."""
    c = Catalog(spark, str(tmp_path / "c"))
    square = lambda x: f"POLYGON (({x} 0, {x + 10} 0, {x + 10} 10, {x} 10, {x} 0))"
    c.overwrite(spark.createDataFrame([(1, "b1", "wagga", square(0)), (2, "b2", "tweed", square(500))], "id long, building_id string, region_name string, footprint_wkt string"), "buildings")
    c.overwrite(spark.createDataFrame([("t", i, 500.0 * (i % 2) + i % 10, float(i % 7), 3.0 + i % 2, 10, 2, 1, float(i)) for i in range(400)], "tile_id string, point_id long, x double, y double, z double, intensity int, classification int, number_of_returns int, gps_time double"), "points")
    c.overwrite(spark.createDataFrame([("p_1-x", 5.0, -20.0, 0.0, "wagga"), ("p_3-x", 505.0, -20.0, 0.0, "tweed")], "pano_id string, x double, y double, heading double, region_name string"), "panoramas")
    c.overwrite(spark.createDataFrame([("p_1-x.jpg", "s/1"), ("p_3-x.jpg", "s/3")], "name string, path string"), "pano_files")
    assert stages.run(c, ["1", "2a", "2b", "3", "6", "9a"]) == {"stage01": 400, "stage02a": 2, "stage02b": 2, "stage03": 2, "stage06": 2, "stage09a": 2}
    assert {d.writes for d in stages.STAGES} >= {"clipped_points", "candidate_views", "downloads", "windows", "ground", "heights", "validation"}
    made = {d.writes for d in stages.STAGES}
    given = {"buildings", "points", "panoramas", "pano_files", "detections", "image_scores", "features", "labels"}
    assert all(n in made | given for d in stages.STAGES for n in d.needs)
    boxes = [(1, 1, 4.0), (2, 2, 4.9), (2, 3, 9.0)]  # the last one is far from a door's shape
    rows = [(i, e, "Front Door", 0.9, 100.0, 100.0, 140.0, 180.0, 1.8 if e < 3 else 30.0, 0.45, bottom + 2.0, bottom, 200, 200, 3.2 if i == 1 else None) for i, e, bottom in boxes]
    kinds = "id long, event_id long, class_name string, confidence double, x1 double, y1 double, x2 double, y2 double, area double, ratio double, top double, bottom double, image_width int, image_height int, nearest_ground_m double"
    c.overwrite(spark.createDataFrame(rows, kinds), "features")
    c.overwrite(spark.createDataFrame([(1, 1.0), (2, 0.9)], "id long, floor_height_m double"), "labels")
    assert stages.run(c, ["7", "8"])["stage07"] == 2
    assert {r["id"]: (r["ffh1"], r["ffh2"], r["ffh3"]) for r in c.table("heights").collect()} == {1: (None, pytest.approx(0.8), pytest.approx(1.0)), 2: (None, None, pytest.approx(0.9))}
    assert {(r["id"], r["ffh_method"]) for r in c.table("validation").collect()} == {(1, "ffh2"), (1, "ffh3"), (2, "ffh3")}
    assert set(stages.run(c, ["1", "2a", "2b", "3", "6", "7", "8", "9a"]).values()) == {0}
