from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plinth.functions import geo
from plinth.functions.registry import register_functions
from plinth.operators import kernels as k
from plinth.operators import pointcloud as pc
from plinth.operators import qa, spatial, views
from plinth.operators.neighbours import nearest
from plinth.operators.overlaps import with_overlap


def test_components_and_holes():
    mask = np.array([[1, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [1, 0, 0, 1]], dtype=bool)
    assert k.labels_of(mask, True).max() == 2 and k.labels_of(mask, False).max() == 4
    r = np.arange(49, dtype=float).reshape(7, 7)
    r[1, 1:4] = 9999.0
    r[3:6, 2:6] = 9999.0
    out = k.fill_holes(r, 9999.0)
    assert (out[1, 1:4] != 9999.0).all() and (out[3:6, 2:6] == 9999.0).all()


def flooded(mask, eight):
    """Components pixel by pixel."""
    out, n = np.zeros(mask.shape, dtype=int), 0
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (eight or not (a and b))]
    for start in zip(*np.nonzero(mask), strict=True):
        if out[start]:
            continue
        n += 1
        out[start], stack = n, [start]
        while stack:
            v, u = stack.pop()
            for a, b in steps:
                if 0 <= v + a < mask.shape[0] and 0 <= u + b < mask.shape[1] and mask[v + a, u + b] and not out[v + a, u + b]:
                    out[v + a, u + b] = n
                    stack.append((v + a, u + b))
    return out


def test_components_are_those_of_a_flood():
    rng = np.random.default_rng(11)
    spiral = np.zeros((41, 41), dtype=bool)
    for r in range(0, 20, 2):
        spiral[r, r:41 - r] = spiral[40 - r, r:41 - r] = spiral[r:41 - r, r] = spiral[r:41 - r, 40 - r] = True
        spiral[r + 1, r] = False
        spiral[r + 2, r + 1] = True
    masks = [rng.random((h, w)) < p for h, w in ((1, 1), (1, 30), (30, 1), (25, 40)) for p in (0.0, 0.3, 0.5, 0.6, 1.0)] + [spiral]
    for mask in masks:
        for eight in (False, True):
            assert np.array_equal(k.labels_of(mask, eight), flooded(mask, eight))


def test_nearest_valid_pixel_is_brute_force():
    rng = np.random.default_rng(12)
    for h, w, p in ((1, 20, 0.1), (20, 1, 0.2), (30, 40, 0.02), (30, 40, 0.5), (25, 25, 0.9)):
        valid = rng.random((h, w)) < p
        valid[rng.integers(h), rng.integers(w)] = True
        v, u = np.nonzero(~valid)
        y, x = np.nonzero(valid)
        got = k.nearest_valid(valid, v, u)
        want = [int(np.argmin((y - a) ** 2 + (x - b) ** 2)) for a, b in zip(v, u, strict=True)]
        assert got[0].tolist() == y[want].tolist() and got[1].tolist() == x[want].tolist()


def test_large_rasters_take_seconds():
    import time

    rng = np.random.default_rng(13)
    raster = np.where(rng.random((3000, 5500)) < 0.02, 9999.0, 1.0)
    began = time.time()
    out = k.fill_holes(raster, 9999.0)
    assert (out == 1.0).all() and time.time() - began < 60


def test_cloth_falls_and_lies_on_steep_slopes():
    """It reaches the ground, hangs over a tower, and lies on the whole of a terrace only with the step for slopes."""
    i, j = (v.ravel() for v in np.indices((30, 12)))
    off = lambda ground, slope: np.abs(k.cloth_surface(i, j, -ground[i, j], slope=slope) + ground[i, j]).reshape(30, 12)
    terrace = np.where(np.arange(30)[:, None] >= 15, 5.0, 0.0) + np.zeros((1, 12))
    assert off(terrace, None).max() > 1 and off(terrace, 0.3).max() < 1e-9
    tower = np.zeros((30, 12))
    tower[10:14, 4:8] = 4.0
    away = off(tower, 0.3)
    assert away[10:14, 4:8].min() > 3 and np.delete(away, slice(10, 14), axis=0).max() < 1e-9


def test_resize_keeps_missing_apart():
    r = np.full((4, 4), 2.0)
    r[:, 3] = 9999.0
    out = k.resize(r, (8, 8), 9999.0)
    assert set(np.unique(out)) == {2.0, 9999.0}
    assert k.resize(np.arange(16.0).reshape(4, 4), (4, 4), 9999.0).tolist() == np.arange(16.0).reshape(4, 4).tolist()


def test_nearest_ground():
    c, z = np.full((6, 6), 6), np.arange(36.0).reshape(6, 6)
    c[0:2, 0:2] = 2
    c[4:6, 3:6] = 2
    assert k.nearest_ground(c, z, 5, 5, 9999.0, 4) == np.median(z[4:6, 3:6])
    assert k.nearest_ground(c, z, 5, 5, 9999.0, 7) is None


@given(st.lists(st.tuples(st.floats(-50, 50), st.floats(-50, 50)), min_size=3, max_size=40))
@settings(max_examples=60, deadline=None)
def test_hull_holds_every_point(points):
    p = np.array(points)
    ring = k.hull(p[:, 0], p[:, 1])
    if len(ring) > 2:
        a, b = ring, np.roll(ring, -1, axis=0)
        for q in p:
            assert ((b[:, 0] - a[:, 0]) * (q[1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (q[0] - a[:, 0]) > -1e-6).all()


def test_simplify_and_buffer():
    ring = np.array([[0, 0], [5, 0.01], [10, 0], [10, 10], [0, 10]], dtype=float)
    assert len(k.simplify(ring, 0.1)) == 4 and len(k.simplify(ring, 0.001)) == 5


def in_pieces(ring, x, y, d, limit=5.0):
    """The buffer as plain Python: the ring, a rectangle a side, a (cut) kite a left turn."""
    inside = False
    n = len(ring)
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    if inside:
        return True
    for i in range(n):
        a, b, c = (np.array(ring[(i + j) % n]) for j in range(3))
        u, v, q = (b - a) / np.hypot(*(b - a)), (c - b) / np.hypot(*(c - b)), np.array([x, y])
        n1, n2 = np.array([u[1], -u[0]]), np.array([v[1], -v[0]])
        if 0 <= (q - a) @ u <= np.hypot(*(b - a)) and 0 <= (q - a) @ n1 <= d:
            return True
        if u[0] * v[1] - u[1] * v[0] > 0 and (q - b) @ u >= 0 >= (q - b) @ v and max((q - b) @ n1, (q - b) @ n2) <= d:
            m = (n1 + n2) / np.hypot(*(n1 + n2))
            if (q - b) @ m <= limit * d:
                return True
    return False


#: A square, an L with a corner that turns right, a sharp spike, and the L clockwise.
RINGS = [
    [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)],
    [(0.0, 0.0), (12.0, 0.0), (12.0, 4.0), (3.0, 4.0), (3.0, 9.0), (0.0, 9.0)],
    [(0.0, 0.0), (20.0, 0.5), (0.0, 1.0)],
]


def test_mitred_buffers_are_brute_force(spark):
    rng = np.random.default_rng(5)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-12, 50, (4000, 2)))]
    rows = [(i, r if i < 3 else r[::-1]) for i, r in enumerate([*RINGS, RINGS[1]])]
    rings = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in rows], "id long, ring array<struct<x: double, y: double>>")
    p = spark.createDataFrame(points, "pid long, x double, y double")
    got = {(r["id"], r["pid"]) for r in spatial.points_in_buffers(p, rings, 7.0, 5.0).collect()}
    want = {(i, pid) for i, r in enumerate([*RINGS, RINGS[1]]) for pid, x, y in points if in_pieces(r, x, y, 5.0)}
    assert got == want
    # the square's buffer is a square; the right-turning corner adds no kite; the spike is cut
    square = {pid for i, pid in got if i == 0}
    assert square == {pid for pid, x, y in points if -5 <= x <= 15 and -5 <= y <= 15}
    assert {pid for i, pid in got if i == 1} == {pid for i, pid in got if i == 3}
    assert max(x for pid, x, y in points if (2, pid) in got) <= 20 + 5 * 5.0 + 1e-9


def test_simplified_rings(spark):
    ring = [{"x": x, "y": y} for x, y in ((0.0, 0.0), (5.0, 0.01), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0))]
    flat = [{"x": float(x), "y": 0.0} for x in range(5)]
    df = spark.createDataFrame([(1, ring), (2, flat)], "id long, ring array<struct<x: double, y: double>>")
    got = {r["id"]: len(r["ring"]) for r in k.simplified(df, 0.1).collect()}
    assert got == {1: 4, 2: 5}


def test_buildings_that_overlap(spark):
    square = lambda x, y, s: [{"x": x + a * s, "y": y + b * s} for a, b in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]
    diamond = [{"x": 5.0 + a, "y": 5.0 + b} for a, b in ((2.0, 0.0), (0.0, 2.0), (-2.0, 0.0), (0.0, -2.0))]
    b = spark.createDataFrame([(1, square(0.0, 0.0, 5.0)), (2, diamond), (3, square(5.0, 0.0, 3.0)), (4, square(40.0, 40.0, 2.0))], "id long, ring array<struct<x: double, y: double>>")
    assert {(r["id"], r["bid"]) for r in spatial.overlapping(b, 4.0).collect()} == {(1, 2), (2, 1)}  # the third only touches
    shared = {(r["id"], r["bid"]): r["area"] for r in with_overlap(b.alias("a").join(b.select(F.col("id").alias("bid"), F.col("ring").alias("other")), F.col("id") < F.col("bid"))).collect()}
    assert shared[1, 2] == pytest.approx(2.0) and shared[1, 3] == 0.0  # a quarter of the diamond; a border has no area


def test_buildings_that_overlap_do_not_block(spark):
    """A target, a blocker between it and the camera, and a neighbour that overlaps the target and reaches before it."""
    box = lambda x0, y0, x1, y1: [{"x": x0, "y": y0}, {"x": x1, "y": y0}, {"x": x1, "y": y1}, {"x": x0, "y": y1}]
    cameras = spark.createDataFrame([(1, 5.0, -25.0), (2, 35.0, 5.0)], "pano_id long, x double, y double")
    target, neighbour, blocker = (1, box(0.0, 0.0, 10.0, 10.0)), (2, box(-2.0, -3.0, 12.0, 1.0)), (3, box(0.0, -15.0, 10.0, -12.0))
    seen = {}
    for name, rows in (("alone", [target]), ("neighbour", [target, neighbour]), ("blocker", [target, neighbour, blocker])):
        b = spark.createDataFrame(rows, "id long, ring array<struct<x: double, y: double>>")
        walls = spatial.edges_of(b).select(F.col("id").alias("bid"), "ax", "ay", "bx", "by")
        rays = spatial.candidate_views(b, cameras)
        free = spatial.visible(rays, walls, 40.0, ("id", "edge_idx", "pano_id"), spatial.overlapping(b, 40.0))
        seen[name] = {(r["edge_idx"], r["pano_id"]) for r in free.collect() if r["id"] == 1}
    assert seen["alone"] == seen["neighbour"] == {(0, 1), (1, 2)}
    assert seen["blocker"] == {(1, 2)}


def numbered(spark, xyz, classification=2):
    rows = [(1, i, *map(float, p), classification) for i, p in enumerate(xyz)]
    return spark.createDataFrame(rows, "tile long, pid long, x double, y double, z double, classification int")


def plain_noise(xyz, n):
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(2))
    away = []
    for i, row in enumerate(d):
        near = xyz[[j for j in np.argsort(row, kind="stable") if j != i][:n]]
        c = near.mean(0)
        away.append(abs((xyz[i] - c) @ np.linalg.svd(near - c)[2][2]))
    return 1.4826 * np.median(np.abs(away - np.median(away)))


def test_noise_and_cloth(spark):
    rng = np.random.default_rng(1)
    x, y = np.meshgrid(np.arange(12.0), np.arange(12.0))
    flat = np.stack([x.ravel(), y.ravel(), np.zeros(144)], axis=1)
    level = lambda p, n: qa.noise_levels(numbered(spark, p), ["tile"], n).first()["noise_level"]
    assert level(flat, 10) < 1e-9
    rough = rng.uniform(0, 12, (150, 3)) * np.array([1, 1, 0.05])
    assert level(rough, 10) == pytest.approx(plain_noise(rough, 10), abs=1e-9)
    issues = {(r["issue_type"], r["severity"]): r["value"] for r in qa.noise(numbered(spark, rough), "tile", most=0.02).collect()}
    assert issues == {("noise", "error"): pytest.approx(plain_noise(rough, 15), abs=1e-9)}
    roof = flat.copy()
    roof[(roof[:, 0] > 4) & (roof[:, 0] < 8) & (roof[:, 1] > 4) & (roof[:, 1] < 8), 2] = 5.0
    kept = {r["pid"] for r in k.ground_points(numbered(spark, roof), "tile").collect()}
    low = set(np.flatnonzero(roof[:, 2] == 0).tolist())
    assert len(kept & low) > 0.9 * len(low) and not kept - low
    far = np.vstack([flat, [[100.0, 100.0, 50.0]]])
    assert {r["pid"] for r in k.ground_points(numbered(spark, far), "tile").collect()} == set(range(144))
    # clearly noisy cells: 36 cells of ten metres with 120 points each
    cells = np.concatenate([rng.uniform(0, 10, (120, 3)) * np.array([1, 1, 0.4]) + np.array([10.0 * i, 10.0 * j, 0]) for i in range(6) for j in range(6)])
    found = {(r["issue_type"], r["severity"]): r["value"] for r in qa.noise(numbered(spark, cells), "tile").collect()}
    assert 30 <= found[("noise", "warning")] <= 36 and ("noise", "error") in found


def test_gaps_in_time(spark):
    rows = [(1, i, float(i) if i < 300 else float(i + 500), 0.0 if i < 300 else 0.5) for i in range(600)]
    df = spark.createDataFrame(rows, "tile long, pid long, gps_time double, z double")
    got = [(r["gps_time"], r["step"], r["jump"]) for r in pc.gps_gaps(df, "tile", ["pid"]).collect()]
    assert got == [(800.0, 501.0, 0.5)]


def test_grid_joins_are_brute_force(spark):
    rng = np.random.default_rng(2)
    p = rng.uniform(-20, 20, (300, 3))
    a = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(p)], "pid long, x double, y double, z double")
    b = a.select(F.col("pid").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz"))
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(2))
    got = {(r["pid"], r["oid"]) for r in spatial.within_distance(a, b, 4.0, ("x", "y", "z"), ("ox", "oy", "oz")).collect()}
    assert got == set(zip(*map(lambda v: v.tolist(), np.nonzero(d <= 4.0)), strict=True))


def by_brute_force(left, right, k):
    """(group, left id, right id, rank) of the k nearest, ties by id."""
    out = set()
    for g, i, *p in left:
        there = sorted((math.dist(p, q), j) for h, j, *q in right if h == g)[:k]
        out |= {(g, i, j, r) for r, (_, j) in enumerate(there, 1)}
    return out


def neighbours_of(spark, left, right, k, dims=3):
    axes = list("xyz")[:dims]
    a = spark.createDataFrame(left, f"tile int, pid long, {', '.join(f'{x} double' for x in axes)}")
    b = spark.createDataFrame(right, f"tile int, oid long, {', '.join(f'o{x} double' for x in axes)}")
    return nearest(a, b, k, axes, [f"o{x}" for x in axes], "pid", "oid", ["tile"])


@pytest.mark.parametrize("dims", [2, 3])
def test_nearest_is_brute_force_at_any_density(spark, dims):
    """Dense and thin clusters, stray points, repeated places, small groups, and left rows where no right ones are."""
    rng = np.random.default_rng(4)
    parts = [rng.normal(0, 0.01, (250, dims)), rng.uniform(-300, 300, (300, dims)), np.repeat(rng.uniform(5, 6, (3, dims)), 40, axis=0), [[9e6] * dims, [-1e12] * dims, [7.0] * dims]]
    rows = [(0, i, *map(float, p)) for i, p in enumerate(np.concatenate(parts))] + [(1, i, float(i), *[0.0] * (dims - 1)) for i in range(3)] + [(2, 0, *[1.0] * dims)]
    other = [r for r in rows if r[1] % 2]
    ask = [(0, 10_000 + i, *map(float, p)) for i, p in enumerate(rng.uniform(-2000, 2000, (40, dims)))]
    for left, right, k in ((rows, rows, 6), (rows[::3], other, 1), (ask, other, 9)):
        got = neighbours_of(spark, left, right, k, dims).collect()
        assert {(r["tile"], r["pid"], r["oid"], r["rank"]) for r in got} == by_brute_force(left, right, k)
        assert len(got) == len({(r["tile"], r["pid"], r["rank"]) for r in got})


def test_far_points_keep_their_neighbours(spark):
    """QA-06: a point 9,000 km off is there, with its true distances; unusable coordinates are nobody's."""
    grid = [(t, t * 1000 + i, float(i % 20), float(i // 20), 0.0) for t in (1, 2) for i in range(400 if t == 1 else 100)]
    p = spark.createDataFrame([*grid, (2, 5000, 9e6, 9e6, 0.0), (2, 5001, None, 1.0, 0.0), (2, 5002, float("nan"), 1.0, 0.0)], "tile int, pid long, x double, y double, z double")
    d = {(r["tile"], r["pid"]): r["d"] for r in qa.neighbour_distances(p, "tile", 5, 2.0).collect()}
    assert len([k for k in d if k[0] == 2]) == 101 and len(d) == 501
    want = sorted(math.dist((9e6, 9e6), (x, y)) for t, _, x, y, _ in grid if t == 2)[:5]
    assert abs(d[2, 5000] - sum(want) / 5) < 1e-6


def test_nearest_by_text_keys_and_empty_sides(spark):
    a = spark.createDataFrame([("b", 0.0), ("a", 0.0), ("c", 2.0)], "pid string, x double")
    b = a.select(F.col("pid").alias("oid"), F.col("x").alias("ox"))
    got = {(r["pid"], r["oid"], r["rank"], r["distance"]) for r in nearest(a, b, 2, ["x"], ["ox"], "pid", "oid").collect()}
    assert got == {("a", "a", 1, 0.0), ("a", "b", 2, 0.0), ("b", "a", 1, 0.0), ("b", "b", 2, 0.0), ("c", "c", 1, 0.0), ("c", "a", 2, 2.0)}
    assert nearest(a, b.limit(0), 2, ["x"], ["ox"], "pid", "oid").count() == 0
    assert nearest(a.limit(0), b, 2, ["x"], ["ox"], "pid", "oid").count() == 0


def test_view_types_at_their_borders(spark):
    want = {0: "direct", 15: "direct", 17: None, 20: "semi_oblique_left", 40: "semi_oblique_left", 42: None, 45: "oblique_left", 50: "oblique_left", 51: None, -15: "direct", -30: "semi_oblique_right", -47: "oblique_right"}
    df = spark.createDataFrame([(float(a),) for a in want], "a double")
    assert {r["a"]: r["t"] for r in df.select("a", geo.view_type(F.col("a")).alias("t")).collect()} == {float(a): t for a, t in want.items()}


def test_bearings_and_rotation(spark):
    rows = [("n", 1.0, 0.0, 0.0), ("e", 0.0, 1.0, 90.0), ("s", -1.0, 0.0, 180.0), ("w", 0.0, -1.0, 270.0)]
    df = spark.createDataFrame(rows, "k string, lat double, lon double, want double")
    for r in df.withColumn("b", F.degrees(geo.bearing(F.lit(0.0), F.lit(0.0), F.col("lat"), F.col("lon")))).collect():
        assert r["b"] == pytest.approx(r["want"], abs=1e-9)
    m = spark.range(1).select(*(v.alias(f"m{i}{j}") for i, row in enumerate(geo.rotation(F.lit(30.0), F.lit(20.0), F.lit(10.0))) for j, v in enumerate(row))).first()
    assert np.allclose(np.array(m).reshape(3, 3) @ np.array(m).reshape(3, 3).T, np.eye(3))


def test_grid_projection(spark):
    # on the central meridian: false easting, and northing from the meridian arc of GRS80
    r = spark.range(1).select(geo.to_grid(F.lit(147.0), F.lit(-41.0), 55).alias("g")).first()["g"]
    assert r["x"] == pytest.approx(500_000, abs=1e-4)
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    phi = np.linspace(0, math.radians(41.0), 200_001)
    arc = np.trapezoid(a * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5, phi)
    assert r["y"] == pytest.approx(10_000_000 - 0.9996 * arc, abs=1e-3)


def test_rings(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)],)], "ring array<struct<x:double,y:double>>")
    r = df.select(geo.area(F.col("ring")).alias("a"), geo.contains(F.col("ring"), F.lit(2.0), F.lit(2.0)).alias("notch"), geo.contains(F.col("ring"), F.lit(0.5), F.lit(2.0)).alias("arm"), F.size(geo.outward_edges(F.col("ring"))).alias("n"), (geo.ring_of(geo.wkt(F.col("ring"))) == F.col("ring")).alias("same")).first()
    assert (r["a"], r["notch"], r["arm"], r["n"], r["same"]) == (10.0, False, True, 5, True)


def test_best_view_rules(spark):
    cols = "id long, pano_id int, edge_idx int, view_type string, combined_score double, distance double, has_door_override boolean"
    rows = [
        (1, 0, 0, "direct", 9.0, 1.0, False), (1, 1, 0, "direct", 1.0, 9.0, True),  # a sole override wins
        (2, 0, 0, "direct", 1.0, 1.0, True), (2, 1, 0, "direct", 2.0, 1.0, True),  # two do not
        (3, 0, 0, "direct", 1.0, 5.0, False), (3, 1, 0, "direct", 1.0, 2.0, False),  # the nearer of equals
    ]
    assert {r["id"]: r["pano_id"] for r in views.best_view(spark.createDataFrame(rows, cols)).collect()} == {1: 1, 2: 1, 3: 1}


def test_heights_are_null_each_by_itself(spark):
    f = spark.createDataFrame([(1, "Front Door", None, 1.5), (1, "Stairs", None, 1.0), (2, "Stairs", None, 0.2), (3, "Foundation", 1.0, float("nan"))], "id long, class_name string, top double, bottom double")
    g = spark.createDataFrame([(1, 0.9, None), (2, 0.1, 0.1), (3, 0.5, 0.5)], "id long, ground_elevation_m double, nearest_ground_m double")
    out = {r["id"]: (r["ffh1"], r["ffh2"], r["ffh3"]) for r in views.floor_heights(f, g).collect()}
    assert out == {1: (0.5, None, pytest.approx(0.6))}


def test_zbuffer_modes(spark):
    p = spark.createDataFrame([(1, 0.0, 1.0, 0.0, "near"), (1, 0.0, 3.0, 0.0, "far")], "k int, x double, y double, z double, pid string")
    e = pc.equirectangular(p, (0.0, 0.0, 0.0), 36, 18)
    assert [pc.zbuffer(e, ["k"], ["pid"], m).first()["pid"] for m in ("nearest", "farthest")] == ["near", "far"]


def test_striping_is_found(spark):
    rows = [(1, i, i / 40, float(i % 7), 0.3 * math.sin(2 * math.pi * i / 40 / 10), 1) for i in range(4000)]
    p = spark.createDataFrame(rows, "tile_id int, pid long, x double, y double, z double, intensity int")
    assert [r["issue_type"] for r in qa.striping(p, "tile_id").collect()] == ["striping"]
    assert qa.striping(p.withColumn("z", F.lit(1.0)), "tile_id").count() == 0


def test_sql_functions(spark):
    assert "pl_bearing" in register_functions(spark)
    r = spark.sql("SELECT pl_bearing(0, 0, 0, 1) AS b, pl_view_type(30) AS t, pl_quality_level(3) AS q, pl_path_key('') AS g, pl_cosine(array(1D, 0D), array(1D, 0D)) AS c").first()
    assert (round(r["b"], 6), r["t"], r["q"], r["g"], r["c"]) == (90.0, "semi_oblique_left", "QL2", "NO_GNAF", 1.0)
