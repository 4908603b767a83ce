from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth.functions import geo
from plinth.operators import overlaps

L = [(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6)]
U = [(0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6)]


def column(rings):
    return pa.array([None if r is None else [{"x": float(x), "y": float(y)} for x, y in r] for r in rings], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def moved(ring, dx, dy):
    return [(x + dx, y + dy) for x, y in ring]


def spans(ring, x):
    """Where the vertical line at x runs inside a ring."""
    ys = sorted(ay + (by - ay) * (x - ax) / (bx - ax) for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True) if (ax > x) != (bx > x))
    return list(zip(ys[::2], ys[1::2], strict=True))


def by_strips(a, b, n=4000):
    lo, hi = max(min(p[0] for p in r) for r in (a, b)), min(max(p[0] for p in r) for r in (a, b))
    if hi <= lo:
        return 0.0
    xs = lo + (hi - lo) * (np.arange(n) + 0.5) / n
    return sum(max(0.0, min(q, s) - max(p, r)) for x in xs for p, q in spans(a, x) for r, s in spans(b, x)) * (hi - lo) / n


def star(rng, n):
    turn, reach = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(1, 10, n)
    return [(float(r * np.cos(t)), float(r * np.sin(t))) for t, r in zip(turn, reach, strict=True)]


@pytest.mark.parametrize(
    ("a", "b", "area"),
    [
        (L, L, 20), (L, L[::-1], 20), (U, U, 28), (L, U, 20), (U, moved(L, 2, 2), 4), (L, moved(L, 6, 0), 0), (L, moved(L, 2, 2), 0), (U, [(2, 2), (4, 2), (4, 6), (2, 6)], 0),
        (U, [(2, 0), (4, 0), (4, 6), (2, 6)], 4), (U, [(1, 4), (5, 4), (5, 5), (1, 5)], 2), ([(0, 0), (10, 0), (10, 10), (0, 10)], moved(L, 2, 2), 20), (L, [(0, 0), (6, 0)], 0), (L, [], 0), (L, None, 0),
        ([*L, L[0]], U, 20), (L, [(0, 0), (3, 0), (6, 0), (6, 1), (0, 1)], 6), (moved(L, 5e5, 6e6), moved(U, 5e5, 6e6), 20),
    ],
)
def test_shared_area_of_shapes(a, b, area):
    assert overlaps.areas(column([a]), column([b]))[0] == pytest.approx(area, abs=1e-6)
    assert overlaps.areas(column([b]), column([a]))[0] == pytest.approx(area, abs=1e-6)


def test_stars_by_strips(monkeypatch):
    rng = np.random.default_rng(9)
    pairs = [(star(rng, int(rng.integers(3, 30))), moved(star(rng, int(rng.integers(3, 30))), *rng.uniform(-8, 8, 2))) for _ in range(40)]
    whole = overlaps.areas(column([p[0] for p in pairs]), column([p[1] for p in pairs]))
    for got, (a, b) in zip(whole, pairs, strict=True):
        assert got == pytest.approx(by_strips(a, b), abs=0.05)
    monkeypatch.setattr(overlaps, "CELLS", 50)  # a pair at a time
    assert np.allclose(overlaps.areas(column([p[0] for p in pairs]), column([p[1] for p in pairs])), whole, atol=1e-9)


def test_rings_that_meet(spark):
    cases = [(L, moved(L, 3, 3), False), (L, moved(L, 2, 2), True), (L, moved(L, 6, 0), True), (L, moved(L, 6.5, 0), False), (U, [(2.5, 3), (3.5, 3), (3.5, 5)], False), ([(-9, -9), (9, -9), (9, 9), (-9, 9)], L, True), (L, [(-9, -9), (9, -9), (9, 9), (-9, 9)], True)]
    point = "array<struct<x: double, y: double>>"
    rows = [(i, *([{"x": float(x), "y": float(y)} for x, y in r] for r in c[:2])) for i, c in enumerate(cases)]
    got = spark.createDataFrame(rows, f"i int, a {point}, b {point}").select("i", geo.intersects(F.col("a"), F.col("b")).alias("m")).collect()
    assert {r["i"]: r["m"] for r in got} == {i: c[2] for i, c in enumerate(cases)}


def test_borders_that_touch_by_their_last_bit():
    """F8: a corner that a sum misses by its last bit; the SQL's boxes share nothing of the second pair."""
    a = [(93.6, 4.600000000000001), (125.6, 4.600000000000001), (125.6, 16.6), (109.6, 16.6), (109.6, 28.6), (93.6, 28.6)]
    b = [(58.400000000000006, 12.6), (70.4, 12.6), (70.4, 4.6), (94.4, 4.6), (94.4, 12.6), (106.4, 12.6), (106.4, -3.4000000000000004), (58.400000000000006, -3.4000000000000004)]
    c = [(80.6, 35.6), (96.6, 35.6), (96.6, 23.6), (112.6, 23.6), (112.6, 11.600000000000001), (80.6, 11.600000000000001)]
    d = [(49.400000000000006, 7.6), (89.4, 7.6), (89.4, 11.6), (69.4, 11.6), (69.4, 15.6), (49.400000000000006, 15.6)]
    assert overlaps.areas(column([a, c]), column([b, d])) == pytest.approx([96.0, 0.0], abs=1e-9)


@pytest.mark.parametrize("pairs, corners, held", [(1 << 16, 32, 1 << 13), (7, 32, 3), (7, 7, 1), (7, 0, 5)])
def test_rings_of_a_cell_are_compared_where_they_are(spark, monkeypatch, pairs, corners, held):
    """rings cut into boxes, others by their edges, and both kinds together, in packs of any size; a copy of a key has no pair with it."""
    rng = np.random.default_rng(4)
    shapes = [*(moved(r, *rng.uniform(-9, 9, 2)) for r in (L, U, L[::-1], U[::-1]) * 4), *(star(rng, 7) for _ in range(4)), L[:2], []]
    shapes.append(shapes[0])
    monkeypatch.setattr(overlaps, "PAIRS", pairs)
    monkeypatch.setattr(overlaps, "CORNERS", corners)
    monkeypatch.setattr(overlaps, "HELD", held)
    rows = [(f"r{i % 22}", [{"x": float(x), "y": float(y)} for x, y in r]) for i, r in enumerate(shapes)]
    told = overlaps.shared_areas(spark.createDataFrame(rows, "a string, ring array<struct<x: double, y: double>>"), "a", "b", 4.0).collect()
    got = {(r["a"], r["b"]): r["area"] for r in told}
    assert len(told) == len(got) + sum("r0" in pair for pair in got)
    keys = [r[0] for r in rows]
    for i, a in enumerate(shapes):
        for j, b in enumerate(shapes):
            if keys[i] < keys[j]:
                assert got.get((keys[i], keys[j]), 0.0) == pytest.approx(overlaps.areas(column([a]), column([b]))[0], abs=1e-9)
    assert all(a < b for a, b in got)
