"""Queries on rows that only larger tables have, against their SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plinth.plans.queries import ENTRIES

from .conftest import DATA
from .oracle import duck, same

SF = f"{DATA}/sf0.001"


def copies(spark, at, **tables):
    """A folder of the least tables with some replaced."""
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        (tables[t] if t in tables else spark.read.parquet(f"{SF}/{t}.parquet")).write.parquet(f"{at}/{t}.parquet")
    return str(at)


def agrees(spark, name, at):
    same(spark, duck(at), entry.queries()[name], ENTRIES[name].sql, at)


def test_sizes_beyond_terabytes(spark, tmp_path):
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    agrees(spark, "bytes_humanised", copies(spark, tmp_path, customer=customer.withColumn("c_custkey", F.col("c_custkey") + 899_000)))


def test_groups_of_any_size_have_the_same_neighbours(spark, monkeypatch):
    """Few rows are compared as a whole, many go by the tree; what is folded is what the pairs tell."""
    from plinth.operators import groups
    from plinth.operators.neighbours import mean_distance, nearest

    p = spark.range(600).select((F.col("id") % 3).alias("t"), F.concat(F.lit("p"), "id").alias("pid"), (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 89).cast("double").alias("y"))
    o = p.select("t", F.col("pid").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    call = lambda *fold: sorted(tuple(r) for r in nearest(p, o, 4, ("x", "y"), ("ox", "oy"), "pid", "oid", ["t"], *fold).collect())
    pairs, means = call(), call((mean_distance, ["d"]))
    assert len(pairs) == 2400 and len(means) == 600
    told = {}
    for row in pairs:
        told.setdefault(row[:2], []).append(row[-2:])
    assert all(abs(d - sum(away for away, rank in told[t, pid] if rank > 1) / 3) < 1e-9 for t, pid, d in means)
    monkeypatch.setattr(groups, "SMALL", 100)
    assert call() == pairs and [r[:2] for r in call((mean_distance, ["d"]))] == [r[:2] for r in means]


def test_few_rows_need_no_tree(spark, monkeypatch):
    """Groups of few rows are dealt once: no table but the list of large groups is written."""
    from plinth import tables
    from plinth.operators import qa
    from plinth.plans.cloud_queries import numbered
    from plinth.plans.standins import view

    mark = tables.written()
    qa.knn_outliers(numbered(view(spark, SF, "points")), "tile_id", 5).collect()
    assert [p.rsplit("/", 1)[-1].split("-")[0] for p in tables._written()[mark:]] == ["large", "distances"]


def test_discs_that_double_find_the_nearest_views(spark):
    """Dense cameras take several rounds; the first disc is narrower than the search."""
    from plinth.functions import geo
    from plinth.operators import spatial

    b = spark.range(4).select("id", geo.box_ring(F.col("id") * 20.0, F.lit(0.0), F.col("id") * 20.0 + 6.0, F.lit(4.0)).alias("ring"))
    cameras = spark.range(4000).select(F.col("id").alias("pano_id"), (F.col("id") * 61 % 1009 / 10.0 - 15).alias("x"), (F.col("id") * 37 % 1013 / 20.0 - 25).alias("y"))
    keys = ["id", "edge_idx", "view_type", "pano_id"]
    want = spatial.chosen(spatial.candidate_views(b, cameras)).where("is_chosen").select(keys)
    assert sorted(spatial.nearest_views(b, cameras).collect()) == sorted(want.collect())


def test_pairs_are_not_left_to_the_tasks_of_a_small_file(spark):
    """Small sides are dealt by cell, not broadcast; rays' rings come with their edges."""
    for name in ("harvest_candidates", "shared_footprints", "clip_points_to_buildings"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 1, name


NEAR = ("radius_outliers", "class_noise", "dense_points", "ghosting", "blooming", "edge_class", "noise_isolation")


def test_neighbours_within_a_radius_are_not_shuffled(spark):
    """points travel once; neither copies of them nor pairs nor counts by point do."""
    for name in ("radius_outliers", "class_noise", "dense_points"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan and "REPARTITION_BY_COL" in plan, name


@pytest.mark.parametrize("small, part", [(1 << 12, 1 << 16), (100, 1 << 16), (100, 40)])
def test_neighbours_of_tiles_of_any_size(spark, monkeypatch, tmp_path, small, part):
    """Tiles as a whole, by cells, and by parts of dense cells; some rows are there twice."""
    from plinth.operators import groups, neighbours

    lines = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("l_suppkey", F.col("l_suppkey") % 3)
    at = copies(spark, tmp_path, lineitem=lines.unionByName(lines.where("l_orderkey % 50 = 0")))
    monkeypatch.setattr(groups, "SMALL", small)
    monkeypatch.setattr(neighbours, "PART", part)
    for name in NEAR:
        agrees(spark, name, at)


def test_rasters_and_cloths_are_dealt_however_few_their_bytes(spark):
    """rasters of few bytes are not merged into one task, and each is looked at once."""
    from plinth.operators.spatial import spread

    n = spread(spark.range(1), "id").rdd.getNumPartitions()
    for name in ("cloth_ground_points", "raster_kernels"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FlatMapGroupsInPandas") == 1 and f", {n}), REPARTITION_BY_NUM" in plan, name


def test_one_look_at_a_raster_tells_what_three_do(spark):
    from plinth.operators import raster

    px = spark.range(1800).select(F.floor(F.col("id") / 600).alias("t"), F.floor(F.col("id") % 600 / 30).cast("int").alias("v"), (F.col("id") % 30).cast("int").alias("u"), (F.col("id") % 13).cast("double").alias("z"), F.when(F.col("id") % 7 < 5, 2).otherwise(6).alias("classification")).where("(u + v) % 9 > 0")
    spots = spark.range(3).select(F.col("id").alias("t"), F.lit(20.0).alias("x"), F.lit(10.0).alias("y"))
    got = raster.surveyed(px, spots, "t", (20, 40), (10, 20), least=2).collect()
    want = raster.resized(raster.filled(px.withColumn("value", F.col("z")), "t", (20, 40)), "t", (20, 40), (10, 20)).collect()
    assert sorted(r[:4] for r in got) == sorted(tuple(r) for r in want) and want
    ground = {r["t"]: r["nearest_ground_m"] for r in raster.ground_reference(px, spots, "t", (20, 40), 2).collect()}
    assert {(r["t"], r["nearest_ground_m"]) for r in got} == set(ground.items()) and None not in ground.values()


def test_reports_look_at_the_points_once(spark):
    """what is left after the written grid is one row a tile, without a join."""
    for name in ("qa_report_rows", "qa_issues_list", "qa_issue_frequency", "qa_summary"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "lineitem" not in plan, name


def test_a_tile_on_the_threshold_of_variation_has_no_issue(spark):
    """counts whose deviation is exactly half their mean, in any order of the cells."""
    from plinth.operators import pointcloud as pc

    rows = [[3] * a + [1] * a for a in (1, 3, 7, 11, 49, 101)] + [[9] * a + [3] * a for a in (5, 23, 97)] + [[21] * a + [7] * a for a in (13, 41)]
    cells = spark.createDataFrame([(t, n, 1, 1) for t, ns in enumerate(rows) for n in ns], "t int, n long, nx int, ny int").repartition(7)
    assert {r["variation"] for r in cells.groupBy("t").agg(*pc.cell_statistics(1.0)).collect()} == {0.5}


def test_checks_deal_the_points_once(spark):
    """all that is written is one row a tile, and the issues are told from that."""
    from plinth import tables

    mark = tables.written()
    plan = entry.queries()["qa_all_aggregate_checks"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert [p.rsplit("/", 1)[-1].split("-")[0] for p in tables._written()[mark:]] == ["large", "tiles"]
    assert "Join" not in plan and "Exchange" not in plan and "lineitem" not in plan


@pytest.mark.parametrize("small, batch", [(1 << 12, 10_000), (1 << 12, 100), (2_050, 10_000), (100, 10_000)])
def test_checks_of_tiles_of_any_size(spark, monkeypatch, tmp_path, small, batch):
    """tiles as a whole, tiles of several batches, and large tiles by joins, some or all; some rows are there twice."""
    from plinth.operators import groups

    lines = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("l_suppkey", F.col("l_suppkey") % 3)
    at = copies(spark, tmp_path, lineitem=lines.unionByName(lines.where("l_orderkey % 50 = 0")))
    monkeypatch.setattr(groups, "SMALL", small)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        agrees(spark, "qa_all_aggregate_checks", at)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_whole_batches_of_groups():
    """Batches that end within a group, at its end, and within the first one; nothing is lost and no group is cut."""
    import pyarrow as pa

    from plinth.operators import groups

    keys = [1] * 5 + [2] + [3] * 9 + [4, 4]
    for size in range(1, 18):
        cut = [pa.RecordBatch.from_pydict({"k": keys[i : i + size], "i": list(range(i, min(i + size, 17)))}) for i in range(0, 17, size)]
        out = [b.to_pydict() for b in groups.together(iter([cut[0].slice(0, 0), *cut]), 1)]
        assert [i for b in out for i in b["i"]] == list(range(17)) and sum(len(set(b["k"])) for b in out) == 4, size
    assert not list(groups.together(iter([]), 1))


@pytest.mark.parametrize("held, pairs", [(1 << 13, 1 << 16), (3, 5)])
def test_views_are_made_where_packs_of_a_cell_meet(spark, monkeypatch, held, pairs):
    """packs of any size, rings that are not convex, ties; views are those of a plain loop."""
    import math

    from plinth.operators import sightlines, spatial

    monkeypatch.setattr(sightlines, "HELD", held)
    monkeypatch.setattr(sightlines, "PAIRS", pairs)
    cup = [(0, 0), (12, 0), (12, 12), (8, 12), (8, 4), (4, 4), (4, 12), (0, 12)]
    shapes = {f"b{i}": [(x + 30.0 * i, y + 7.0 * i) for x, y in (cup if i % 2 else cup[:3] + [(0, 12)])] for i in range(4)}
    cameras = [(f"p{i}", i * 37 % 101 + 0.5 * (i % 2), i * 53 % 97 - 40.0) for i in range(60)] + [("o5", 37.5, 265.0 % 97 - 40.0), ("q", None, 1.0)]
    b = spark.createDataFrame([(k, [{"x": float(x), "y": float(y)} for x, y in r]) for k, r in shapes.items()], "id string, ring array<struct<x: double, y: double>>")
    p = spark.createDataFrame([(k, x, y) for k, x, y in cameras], "pano_id string, x double, y double")
    held_by = lambda r, x, y: sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1], strict=True)) % 2 == 1
    want = {}
    for e in spatial.ringed_edges(b).collect():
        for k, x, y in cameras[:-1]:
            vx, vy = x - e.mx, y - e.my
            angle = math.degrees(math.atan2(e.nx * vy - e.ny * vx, e.nx * vx + e.ny * vy))
            kind = next((n for n, lo, hi in (("direct", -15, 15), ("semi_oblique_left", 20, 40), ("semi_oblique_right", -40, -20), ("oblique_left", 45, 50), ("oblique_right", -50, -45)) if lo - 1e-8 <= angle <= hi + 1e-8), None)
            if vx * vx + vy * vy <= 1600 and kind and not held_by(shapes[e.id], x, y):
                want[e.id, e.edge_idx, k] = (kind, math.hypot(vx, vy), angle)
    got = {(r.id, r.edge_idx, r.pano_id): (r.view_type, r.distance, r.angle) for r in spatial.candidate_views(b, p).collect()}
    assert got.keys() == want.keys() and want
    assert all(got[k][0] == v[0] and got[k][1:] == pytest.approx(v[1:], abs=1e-9) for k, v in want.items())
    best = {}
    for (i, e, k), (kind, away, _) in want.items():
        best[i, e, kind] = min(best.get((i, e, kind), (math.inf, "")), (away, k))
    assert {tuple(r) for r in spatial.nearest_views(b, p).collect()} == {(*k, v[1]) for k, v in best.items()}


@pytest.mark.parametrize("held, pairs", [(1 << 13, 1 << 16), (5, 7)])
def test_rays_end_where_they_are_made(spark, monkeypatch, held, pairs):
    """rays are not written, and those that are left are the SQL's, in packs of any size."""
    from plinth import tables
    from plinth.operators import sightlines

    monkeypatch.setattr(sightlines, "HELD", held)
    monkeypatch.setattr(sightlines, "PAIRS", pairs)
    mark = tables.written()
    agrees(spark, "ray_occlusion", SF)
    assert "rays" not in [p.rsplit("/", 1)[-1].split("-")[0] for p in tables._written()[mark:]]
