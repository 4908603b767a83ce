"""Hulls of parts and of hulls against the hull of all points."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from plinth.operators import hulls as h, kernels, spatial


def frame(spark, rows, parts=7):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["k", "x", "y"])).repartition(parts)


def rings_of(df):
    return {r["k"]: np.array([(p["x"], p["y"]) for p in r["ring"]]) for r in df.collect()}


@pytest.mark.parametrize("held", [h.HELD, 10])
def test_hulls_are_those_of_all_points(spark, monkeypatch, held):
    monkeypatch.setattr(h, "HELD", held)
    rng = np.random.default_rng(3)
    turn = rng.uniform(0, 2 * np.pi, 300)
    shapes = {1: rng.normal(0, 5, (4000, 2)), 2: np.stack([np.cos(turn), np.sin(turn)], 1) * 50, 3: rng.integers(0, 6, (500, 2)).astype(float)}
    rows = [(k, x, y) for k, xy in shapes.items() for x, y in xy]
    found = rings_of(h.hulls(frame(spark, rows), ["k"]))
    assert set(found) == {1, 2, 3}
    for k, xy in shapes.items():
        np.testing.assert_array_equal(found[k], kernels.hull(xy[:, 0], xy[:, 1]))
    areas = {r["k"]: (r["convex_hull_area"], r["corners"]) for r in h.hull_areas(frame(spark, rows), "k").collect()}
    assert areas[3] == (25.0, 4)


def test_awkward_groups(spark):
    rows = [("one", 1.0, 2.0)] * 3 + [("line", float(i), 2.0 * i) for i in range(50)] + [("lost", float("nan"), 1.0), (None, 1.0, 1.0), ("part", 1.0, None)]
    found = rings_of(h.hulls(frame(spark, rows), ["k"]))
    assert {k: r.tolist() for k, r in found.items()} == {"one": [[1.0, 2.0]], "line": [[0.0, 0.0], [49.0, 98.0]]}
    assert {r["k"]: r["convex_hull_area"] for r in h.hull_areas(frame(spark, rows), "k").collect()} == {"one": 0.0, "line": 0.0}
    assert h.hulls(frame(spark, rows).limit(0), ["k"]).count() == 0
    whole = h.hulls(frame(spark, rows), []).collect()
    assert len(whole) == 1 and len(whole[0]["ring"]) == 3


def test_points_near_rings_are_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [("a", x, y) for x, y in rng.uniform(0, 60, (40, 2))] + [("dot", 80.0, 80.0)]
    rings = h.hulls(frame(spark, rows), ["k"])
    xy = rng.uniform(-60, 140, (600, 2))
    points = spark.createDataFrame(pd.DataFrame({"pid": range(600), "x": xy[:, 0], "y": xy[:, 1]}))
    found = {(r["k"], r["pid"]): r["distance"] for r in spatial.points_near_rings(points, rings, 17.0, 25.0).collect()}
    want = {}
    for k, ring in rings_of(rings).items():
        a, d = ring, np.roll(ring, -1, axis=0) - ring
        for i, q in enumerate(xy):
            t = np.clip(((q - a) * d).sum(1) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
            inside = len(ring) > 2 and (d[:, 0] * (q[1] - a[:, 1]) - d[:, 1] * (q[0] - a[:, 0]) > 0).all()
            away = 0.0 if inside else np.hypot(*(q - (a + t[:, None] * d)).T).min()
            if away <= 25.0:
                want[k, i] = away
    assert found.keys() == want.keys()
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)
