"""Quality checks of point cloud tiles.  A check is a DataFrame (key, issue_type, severity, value); all are exact.

Neighbours within a radius are counted where a tile's points are (small tiles as a whole, larger ones by cells), so that neither
pairs nor counts by point are shuffled; what is told is a row a tile or a cell.

Checks that follow from numbers of a tile are RULES over one row a tile.  run_checks() gets that row for all checks
together: tiles of few rows are dealt once and told of as a whole, larger ones take two passes over the points; two looks at
neighbours follow, each at the greatest radius that its checks ask for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..tables import durable
from . import groups, tilewise
from .neighbours import after_first, around, blocks, counted, mean_distance, nearest
from .pointcloud import PLANE_SUMS, cell_statistics, density_grid, fitted_plane, gps_gaps, in_grid, plane_residual
from .quantiles import aggregated

SEVERITIES = ("info", "warning", "error", "critical")


#: Issues by check: type, severity, value and condition over one row a tile.  The thresholds are fixed values.
RULES: dict[str, tuple[tuple[str, str, str, str], ...]] = {
    "density": (
        ("low_density", "CASE WHEN mean_density < 1.0 THEN 'critical' ELSE 'error' END", "mean_density", "mean_density < 2.0"),
        ("density_variation", "'warning'", "variation", "variation > 0.5"),
        ("data_void", "CASE WHEN void_ratio > 0.1 THEN 'error' ELSE 'warning' END", "void_ratio", "void_ratio > 0.05"),
    ),
    "alignment": (("misalignment", "'warning'", "residual_std", "residual_std > 0.5"),),
    "edge_artifacts": (
        ("edge_artifacts", "'warning'", "edge_share", "edge_share > 0.1"),
        ("intensity_banding", "'warning'", "intensity_ratio", "n_edge > 100 AND n_centre > 100 AND (intensity_ratio < 0.5 OR intensity_ratio > 2.0)"),
    ),
    "blind_spots": (("blind_spots", "'info'", "centre_share", "centre_share < 0.001"),),
    "outliers": (("outliers", "'warning'", "radius_ratio", "radius_ratio > 0.01"),),
    "ghosting": (("ghosting", "'warning'", "candidates", "candidates > 5"),),
    "blooming": (("blooming", "'warning'", "regions", "regions > 3"),),
    "completeness": (
        ("unclassified", "'critical'", "1.0", "known = 0"),
        ("unclassified", "CASE WHEN unclassified > 0.1 THEN 'error' ELSE 'warning' END", "unclassified", "known > 0 AND unclassified > 0.02"),
        ("misclassification", "'warning'", "ground", "known > 0 AND ground < 0.05"),
        ("class_distribution", "'info'", "classes", "known > 0"),
    ),
    "misclassification": (
        ("misclassification", "'warning'", "high_ground", "n2 > 10 AND high_ground > 0.01"),
        ("misclassification", "'warning'", "low_building", "n2 > 10 AND n6 > 10 AND low_building > 0.1"),
        *(("misclassification", "'warning'", f"veg{v}", f"n2 > 10 AND veg{v} > 0.2") for v in (3, 4, 5)),
    ),
    "class_noise": (("classification_noise", "'warning'", "noise", "noise > 0.05"),),
    "edge_class": (("misclassification", "'warning'", "quality", "quality < 0.7"),),
    "noise_points": (("misclassification", "'warning'", "crowded", "crowded > 0.3"),),
}


def ruled(tiles: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """The issues of the named checks' rules, and the check, from one row a tile: one pass, no union."""
    return tiles.select(key, F.explode(found_by(names)).alias("i")).select(key, "i.*")


def found_by(names: Sequence[str]) -> Column:
    """The issues of the named checks' rules on one row a tile, as an array."""
    rules = [(name, *rule) for name in names for rule in RULES[name]]
    found = (F.when(F.expr(when), F.struct(F.lit(kind).alias("issue_type"), F.expr(severity).alias("severity"), F.expr(value).cast("double").alias("value"), F.lit(name).alias("check"))) for name, kind, severity, value, when in rules)
    return F.filter(F.array(*found), lambda i: i.isNotNull())


def issue(df: DataFrame, key: str, kind: str, severity: Column | str, value: Column | str, when: Column) -> DataFrame:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    value = F.col(value) if isinstance(value, str) else value
    return df.where(when).select(key, F.lit(kind).alias("issue_type"), severity.alias("severity"), value.cast("double").alias("value"))


def density(points: DataFrame, key: str, cell: float = 1.0) -> DataFrame:
    """QA-01."""
    return ruled(density_grid(points, key, cell), key, ["density"]).drop("check")


def strip_profile(points: DataFrame, key: str, bins: int = 99, least: int = 10) -> DataFrame:
    """QA-02: median height of each of 99 equal strips in x that has more than 10 points; the greatest x is in none."""
    box = points.groupBy(key).agg(F.min("x").alias("x0"), F.max("x").alias("x1"))
    at = points.join(box, key).withColumn("strip", F.floor(F.try_divide((F.col("x") - F.col("x0")) * bins, F.col("x1") - F.col("x0"))).cast("int"))
    return aggregated(at.where(F.col("strip") < bins), [key, "strip"], [F.count("*").alias("n")], {"median_z": ("z", 0.5, None)}).where(F.col("n") > least)


def striping(points: DataFrame, key: str, offset: float = 0.1, bins: int = 99) -> DataFrame:
    """QA-02: power of the strongest wave in the profile against ten times the mean power; at most bins values a tile."""
    profile = strip_profile(points, key, bins)
    order = F.transform(F.array_sort(F.collect_list(F.struct("strip", "median_z"))), lambda s: s["median_z"])  # bins at most
    p = profile.groupBy(key).agg(order.alias("h"), F.stddev_pop("median_z").alias("amplitude"), F.avg("median_z").alias("m")).where(F.size("h") > 10)
    n = F.size("h")

    def power(k: Column) -> Column:
        turn = lambda f: F.aggregate(F.transform("h", lambda h, i: (h - F.col("m")) * f(2 * math.pi * k * i / n)), F.lit(0.0), lambda a, x: a + x)
        return F.pow(turn(F.cos), F.lit(2.0)) + F.pow(turn(F.sin), F.lit(2.0))

    p = p.withColumn("power", F.transform(F.sequence(F.lit(0), n - 1), power))
    mean = F.aggregate("power", F.lit(0.0), lambda a, x: a + x) / n
    strongest = F.array_max(F.slice("power", F.lit(2), F.floor(n / 2).cast("int") - 1))
    return issue(p, key, "striping", "error", "amplitude", (strongest > 10 * mean) & (F.col("amplitude") > offset))


def jumps(points: DataFrame, key: str, order: Sequence[str], jump: float = 0.10) -> DataFrame:
    """QA-03: gaps in time over which the height changes."""
    return issue(gps_gaps(points, key, order), key, "misalignment", "error", F.abs("jump"), F.abs("jump") > jump)


def alignment(points: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """QA-03."""
    return jumps(points, key, order).unionByName(ruled(plane_residual(points, key), key, ["alignment"]).drop("check"))


def _angles(limit: float = 20.0) -> list[Column]:
    a = F.abs("scan_angle")
    return [(F.count_if(a > limit) / F.count("*")).alias("edge_share"), F.count_if(a > 15).alias("n_edge"), F.count_if(a < 5).alias("n_centre"), F.avg(F.when(a > 15, F.col("intensity"))).alias("i_edge"), F.avg(F.when(a < 5, F.col("intensity"))).alias("i_centre")]


def edge_shares(points: DataFrame, key: str, limit: float = 20.0) -> DataFrame:
    """QA-04."""
    return points.groupBy(key).agg(*_angles(limit)).withColumn("intensity_ratio", F.try_divide("i_edge", "i_centre"))


def edge_artifacts(points: DataFrame, key: str) -> DataFrame:
    return ruled(edge_shares(points, key), key, ["edge_artifacts"]).drop("check")


def centre_share(points: DataFrame, key: str, radius: float = 0.5) -> DataFrame:
    """QA-05: share of points near the centre of the tile's box."""
    c = points.groupBy(key).agg(((F.min("x") + F.max("x")) / 2).alias("__x"), ((F.min("y") + F.max("y")) / 2).alias("__y"))
    near = F.hypot(F.col("x") - F.col("__x"), F.col("y") - F.col("__y")) < radius
    return points.join(c, key).groupBy(key).agg((F.count_if(near) / F.count("*")).alias("centre_share"))


def blind_spots(points: DataFrame, key: str) -> DataFrame:
    return ruled(centre_share(points, key), key, ["blind_spots"]).drop("check")


def _other(points: DataFrame, *more: str, key: str) -> DataFrame:
    return points.select(key, F.col("pid").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz"), *(F.col(m).alias(f"o_{m}") for m in more))


def _merged(ids: pa.Array, rows: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows and their counts with rows of one id made one: the first of them, with the sum of their counts."""
    code = ids.take(pa.array(rows)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.unique(code, return_index=True)[1]
    if len(first) == len(rows):
        return rows, list(counts)
    out = [np.zeros((len(first), c.shape[1])) for c in counts]
    for o, c in zip(out, counts, strict=True):
        np.add.at(o, code, c)
    return rows[first], out


def _marks(kinds: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of a group from the least on, null last (as 2**31), the class of each point, and points by classes as ones."""
    c = kinds.cast(pa.int64()).fill_null(1 << 31).to_numpy(zero_copy_only=False)
    classes, at = np.unique(c, return_inverse=True)
    return classes, c, np.eye(len(classes))[at]


def _numbers(radius: float, tell) -> Callable[[np.ndarray, np.ndarray, list[pa.Array]], list]:
    """What tell makes of the rows' numbers of neighbours; the first column carried is the id."""

    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        rows, (n,) = _merged(more[0], rows, *counted(at, rows, np.ones((len(at), 1)), radius))
        return tell(rows, n[:, 0], more)

    return fold


def _summed(told: DataFrame, key: str) -> DataFrame:
    """A row a tile from rows a tile or a cell."""
    return told.groupBy(key).agg(*(F.sum(c).alias(c) for c in told.columns if c != key))


def radius_outliers(points: DataFrame, key: str, radius: float = 0.5, least: int = 5) -> DataFrame:
    """QA-07: points with fewer than 5 neighbours, themselves counted."""
    fold = _numbers(radius, lambda rows, n, more: [[len(rows)], [int((n < least).sum())]])
    return _summed(around(points, radius, "xyz", [key], ["pid"], fold, "points bigint, outliers bigint"), key).withColumn("ratio", F.col("outliers") / F.col("points"))


def neighbour_distances(points: DataFrame, key: str, k: int, factor: float) -> DataFrame:
    """key, pid, d, limit, points: each point's mean distance to its k neighbours, and the tile's mean and factor deviations."""
    mean = durable(nearest(points, _other(points, key=key), k + 1, ("x", "y", "z"), ("ox", "oy", "oz"), "pid", "oid", [key], (mean_distance, ["d"])), "distances")
    limit = mean.groupBy(key).agg((F.avg("d") + factor * F.stddev_pop("d")).alias("limit"), F.count("*").alias("points"))
    return mean.join(limit, key)


def knn_outliers(points: DataFrame, key: str, k: int = 20, factor: float = 2.0) -> DataFrame:
    """QA-06: points whose mean distance to their k neighbours exceeds the tile's mean by two deviations."""
    return neighbour_distances(points, key, k, factor).groupBy(key).agg(F.max("points").alias("points"), F.count_if(F.col("d") > F.col("limit")).alias("outliers")).withColumn("ratio", F.col("outliers") / F.col("points"))


def plane_distances(points: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """PC-23: by, pid, away: how far each point lies from the plane through its k nearest points."""
    others = points.select(*by, F.col("pid").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz"))
    def away(at: np.ndarray, where: np.ndarray, rows: np.ndarray, cols: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        later, kept, start, n = after_first(rows)
        if not len(kept):
            return kept, [np.zeros(0)]
        off = where[cols[later]] - at[rows[later]]
        mean = lambda v: np.add.reduceat(v, start) / n
        centre = np.stack([mean(off[:, i]) for i in range(3)], axis=1)
        spread = np.stack([mean(off[:, i] * off[:, j]) for i in range(3) for j in range(3)], axis=1).reshape(-1, 3, 3) - centre[:, :, None] * centre[:, None, :]
        return kept, [np.abs((np.linalg.eigh(spread)[1][:, :, 0] * centre).sum(1))]

    return nearest(points, others, k + 1, ("x", "y", "z"), ("ox", "oy", "oz"), "pid", "oid", by, (away, ["away"]))


def noise_levels(points: DataFrame, by: Sequence[str], k: int = 15) -> DataFrame:
    """PC-23: 1.4826 times the median deviation of the distances to local planes, over all points of each group."""
    away = durable(plane_distances(points, by, k), "planes")
    middle = aggregated(away, by, [], {"__m": ("away", 0.5, None)})
    off = away.join(middle, list(by)).withColumn("__d", F.abs(F.col("away") - F.col("__m")))
    return aggregated(off, by, [], {"__d": ("__d", 0.5, None)}).select(*by, (1.4826 * F.col("__d")).alias("noise_level"))


def noise(points: DataFrame, key: str, most: float = 0.05, cell: float = 10.0, least: int = 100, few: int = 5) -> DataFrame:
    """QA-08: the noise of a tile, and tiles with over five noisy cells of ten metres; cells count with over 100 points."""
    whole = noise_levels(points, [key])
    box = points.groupBy(key).agg(F.min("x").alias("__x"), F.min("y").alias("__y"), F.max("x").alias("__u"), F.max("y").alias("__v"))
    index = lambda v, lo: F.floor((F.col(v) - F.col(lo)) / cell).cast("long")
    bins = lambda lo, hi: F.ceil((F.col(hi) - F.col(lo)) / cell)
    at = points.join(box, key).withColumns({"__i": index("x", "__x"), "__j": index("y", "__y")})
    at = at.where((F.col("__i") < bins("__x", "__u")) & (F.col("__j") < bins("__y", "__v"))).select(key, "__i", "__j", "pid", "x", "y", "z")
    full = at.groupBy(key, "__i", "__j").agg(F.count("*").alias("__n")).where(F.col("__n") > least).drop("__n")
    cells = noise_levels(at.join(full, [key, "__i", "__j"], "left_semi"), [key, "__i", "__j"], 10)
    noisy = cells.where(F.col("noise_level") > 2 * most).groupBy(key).agg(F.count("*").alias("cells"))
    severity = F.when(F.col("noise_level") > 2 * most, "error").otherwise("warning")
    return issue(whole, key, "noise", severity, "noise_level", F.col("noise_level") > most).unionByName(issue(noisy, key, "noise", "warning", "cells", F.col("cells") > few))


def far_outliers(points: DataFrame, key: str) -> DataFrame:
    """QA-06 as issues."""
    severity = F.when(F.col("ratio") > 0.04, "error").otherwise("warning")
    return issue(knn_outliers(points, key), key, "outliers", severity, "ratio", F.col("ratio") > 0.02)


def outliers(points: DataFrame, key: str) -> DataFrame:
    r = radius_outliers(points, key).withColumnRenamed("ratio", "radius_ratio")
    return far_outliers(points, key).unionByName(ruled(r, key, ["outliers"]).drop("check"))


def bright(points: DataFrame, key: str, p: float, least: int) -> DataFrame:
    """The points of tiles with more than least points above a percentile of the tile's intensity; lit tells which are."""
    cut = aggregated(points, [key], [], {"__cut": ("intensity", p, None)})
    at = points.join(cut, key)
    many = at.groupBy(key).agg(F.count_if(F.col("intensity") > F.col("__cut")).alias("__n")).where(F.col("__n") > least).select(key)
    return at.join(many, key, "left_semi").withColumn("lit", F.coalesce(F.col("intensity") > F.col("__cut"), F.lit(False))).drop("__cut")


def _raised(at: np.ndarray, rows: np.ndarray, n: np.ndarray, radius: float, rise: float) -> int:
    """How many of the rows with over ten neighbours lie more than rise above their median."""
    rows, up = rows[n > 10], 0
    for part, d2 in blocks(at, rows):
        for row, near in zip(rows[part], d2 <= radius * radius, strict=True):
            up += bool(at[row, 2] - np.median(at[near, 2]) > rise)
    return up


def ghost_candidates(points: DataFrame, key: str, radius: float = 2.0, rise: float = 0.5) -> DataFrame:
    """QA-09: bright points more than half a metre above the median of over ten neighbours."""
    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        rows, (n,) = _merged(more[0], rows, *counted(at, rows, np.ones((len(at), 1)), radius))
        return [[_raised(at, rows, n[:, 0], radius, rise)]]

    return _summed(around(bright(points, key, 0.95, 10), radius, "xyz", [key], ["pid"], fold, "candidates bigint", F.col("lit")), key).where("candidates > 0")


def ghosting(points: DataFrame, key: str) -> DataFrame:
    return ruled(ghost_candidates(points, key), key, ["ghosting"]).drop("check")


def bloom_regions(points: DataFrame, key: str, radius: float = 0.5, factor: float = 3.0, p: float = 0.99) -> DataFrame:
    """QA-10: bright points around which points are three times as dense as in the tile."""
    mean = points.groupBy(key).agg(F.try_divide(F.count("*"), (F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))).alias("mean"))
    fold = _numbers(radius, lambda rows, n, more: [n.astype(np.int64)])
    near = around(bright(points, key, p, 50), radius, "xyz", [key], ["pid"], fold, "n bigint", F.col("lit")).join(mean, key)
    return near.where(F.col("n") / (math.pi * radius * radius) > factor * F.col("mean")).groupBy(key).agg(F.count("*").alias("regions"))


def blooming(points: DataFrame, key: str) -> DataFrame:
    return ruled(bloom_regions(points, key), key, ["blooming"]).drop("check")


def weather_scores(points: DataFrame, key: str, rise: float = 2.0) -> DataFrame:
    """QA-11: how far apart points well above the 95th percentile lie, against evenly scattered ones; twice that if they are dark."""
    cut = aggregated(points, [key], [], {"cut": ("z", 0.95, None), "all_i": ("intensity", 0.5, None)}).withColumn("cut", F.col("cut") + rise)
    high = points.join(cut, key).where("z > cut")
    plain = [F.count("*").alias("n"), ((F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))).alias("area"), F.first("all_i").alias("all_i")]
    box = aggregated(high, [key], plain, {"high_i": ("intensity", 0.5, None)}).where("n > 100")
    own = high.join(box.select(key), key, "left_semi")
    near = nearest(own, own.select(key, F.col("pid").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy")), 2, ("x", "y"), ("ox", "oy"), "pid", "oid", [key], (mean_distance, ["d"]))
    mean = near.groupBy(key).agg(F.avg("d").alias("d"))
    out = mean.join(box, key).withColumn("scatter", F.coalesce(F.try_divide(F.col("d"), 0.5 * F.sqrt(F.col("area") / F.col("n"))), F.lit(0.0)))
    dark = F.try_divide(F.col("high_i"), F.col("all_i")) < 0.2
    return out.select(key, "n", "scatter", F.when(dark, 2 * F.col("scatter")).otherwise(F.col("scatter")).alias("score"))


def weather(points: DataFrame, key: str) -> DataFrame:
    return issue(weather_scores(points, key), key, "weather_noise", "warning", "score", F.col("score") > 0.8)


def _kinds() -> list[Column]:
    """QA-12: a class is one byte, so the set of a tile's classes is small."""
    c = F.col("classification")
    return [F.count(c).alias("known"), F.try_divide(F.count_if(c.isin(0, 1)), F.count("*")).alias("unclassified"), F.try_divide(F.count_if(c == 2), F.count("*")).alias("ground"), F.size(F.collect_set(c)).alias("classes")]


def completeness(points: DataFrame, key: str) -> DataFrame:
    """QA-12."""
    return ruled(points.groupBy(key).agg(*_kinds()), key, ["completeness"]).drop("check")


def _misplaced(low: float) -> dict[str, Column]:
    """QA-13: points at the wrong height for their class, over the tile's z0 (lowest point) and gm (median of the ground)."""
    c, above = F.col("classification"), F.col("z") - F.col("gm")
    out_of = {3: (above < 0.0) | (above > 0.5), 4: (above < 0.5) | (above > 2.0), 5: above < 2.0}
    return {"high_ground": (c == 2) & (F.col("z") > F.col("z0") + 5.0), "low_building": (c == 6) & (F.col("z") < F.col("gm") + low), **{f"veg{v}": (c == v) & out_of[v] for v in (3, 4, 5)}}


def _shares(wrong: dict[str, Column], n: dict[int, Column]) -> list[Column]:
    """QA-13: shares from counts of misplaced points and of their classes; of vegetation only where there are over 100."""
    of = {"high_ground": n[2], "low_building": n[6]}
    return [*(F.try_divide(wrong[k], of[k]).alias(k) for k in of), *(F.when(n[v] > 100, F.try_divide(wrong[f"veg{v}"], n[v])).alias(f"veg{v}") for v in (3, 4, 5))]


def class_shares(points: DataFrame, key: str, low: float = 0.5) -> DataFrame:
    """QA-13: shares of ground far above the lowest point, of buildings at ground height, of vegetation outside its band."""
    plain = [F.min("z").alias("z0"), *(F.count_if(F.col("classification") == v).alias(f"n{v}") for v in (2, 3, 4, 5, 6))]
    base = aggregated(points, [key], plain, {"gm": ("z", 0.5, "classification = 2")})
    n = {v: F.max(f"n{v}") for v in (2, 3, 4, 5, 6)}
    return points.join(base, key).groupBy(key).agg(n[2].alias("n2"), n[6].alias("n6"), *_shares({k: F.count_if(w) for k, w in _misplaced(low).items()}, n))


def misclassification(points: DataFrame, key: str) -> DataFrame:
    return ruled(class_shares(points, key), key, ["misclassification"]).drop("check")


def _changed(n: np.ndarray, classes: np.ndarray, own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """QA-14: rows whose class is not the commonest (the least class, if tied) among over least neighbours, and the numbers of their own class."""
    top = classes[n.argmax(axis=1)]
    known = (own < 1 << 31) & (top < 1 << 31)
    same = np.where(own < 1 << 31, n[np.arange(len(n)), np.searchsorted(classes, own)], 0)
    return known & (n.sum(axis=1) > least) & (top != own), same


def class_noise_shares(points: DataFrame, key: str, radius: float = 1.0, least: int = 10) -> DataFrame:
    """QA-14: share of points whose class is not the commonest (the least class, if tied) among over ten neighbours."""
    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        classes, c, marks = _marks(more[1])
        rows, (n,) = _merged(more[0], rows, *counted(at, rows, marks, radius))
        change, same = _changed(n, classes, c[rows], least)
        return [[len(rows)], [int(change.sum())], [int((change & (same < 3)).sum())]]

    told = _summed(around(points, radius, "xyz", [key], ["pid", "classification"], fold, "n bigint, changed bigint, lone bigint"), key)
    return told.select(key, (F.col("changed") / F.col("n")).alias("noise"), (F.col("lone") / F.col("n")).alias("isolated"))


def class_noise(points: DataFrame, key: str) -> DataFrame:
    return ruled(class_noise_shares(points, key), key, ["class_noise"]).drop("check")


def _mixed(ground: np.ndarray, building: np.ndarray) -> tuple[int, int]:
    """QA-15: how many rows have ground near, and of how many of them it is evenly mixed with buildings."""
    mix = ground[ground > 0] / (ground + building)[ground > 0]
    return len(mix), int(((mix > 0.3) & (mix < 0.7)).sum())


def edge_quality(points: DataFrame, key: str, width: float = 0.5, least: int = 100) -> DataFrame:
    """QA-15: of buildings' points near ground, the share that is not evenly mixed with it; tiles with 100 of each class and over 100 such points."""
    counts = points.groupBy(key).agg(F.count_if(F.col("classification") == 2).alias("n2"), F.count_if(F.col("classification") == 6).alias("n6")).where("n2 >= 100 AND n6 >= 100").select(key)
    own = points.where("classification IN (2, 6)").join(counts, key, "left_semi")

    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        c = more[1].to_numpy(zero_copy_only=False)
        _, (n,) = _merged(more[0], rows, *counted(at, rows, np.stack([c == 2, c == 6], axis=1).astype(float), width))
        return [[v] for v in _mixed(n[:, 0], n[:, 1])]

    told = _summed(around(own, width, "xyz", [key], ["pid", "classification"], fold, "edge_points bigint, mixed bigint", F.col("classification") == 6), key)
    return told.where(F.col("edge_points") > least).select(key, "edge_points", (1.0 - F.col("mixed") / F.col("edge_points")).alias("quality"))


def edge_class(points: DataFrame, key: str) -> DataFrame:
    return ruled(edge_quality(points, key), key, ["edge_class"]).drop("check")


def noise_isolation(points: DataFrame, key: str, radius: float = 2.0, most: int = 5) -> DataFrame:
    """QA-16: of noise points (ten at least), the share with more than five neighbours."""
    many = points.groupBy(key).agg(F.count_if(F.col("classification") == 7).alias("n")).where("n >= 10").select(key)
    fold = _numbers(radius, lambda rows, n, more: [[len(rows)], [int((n > most).sum())]])
    told = _summed(around(points.join(many, key, "left_semi"), radius, "xyz", [key], ["pid"], fold, "noise_points bigint, crowded bigint", F.col("classification") == 7), key)
    return told.select(key, "noise_points", (F.col("crowded") / F.col("noise_points")).alias("crowded"))


def noise_points(points: DataFrame, key: str) -> DataFrame:
    return ruled(noise_isolation(points, key), key, ["noise_points"]).drop("check")


#: QA-17: every check by name; each takes (points, key).
CHECKS = {
    "density": density,
    "striping": striping,
    "alignment": lambda p, k: alignment(p, k, ["pid"]),
    "edge_artifacts": edge_artifacts,
    "blind_spots": blind_spots,
    "outliers": outliers,
    "noise": noise,
    "ghosting": ghosting,
    "blooming": blooming,
    "weather": weather,
    "completeness": completeness,
    "misclassification": misclassification,
    "class_noise": class_noise,
    "edge_class": edge_class,
    "noise_points": noise_points,
}


#: Checks that need more than rules, and what they need.
MORE = {"striping": striping, "alignment": lambda p, k: jumps(p, k, ["pid"]), "outliers": far_outliers, "noise": noise, "weather": weather}
#: Of these, what whole_tiles() tells: the type of issue, all of them errors, and their values.
TOLD = {"striping": ("striping", "filter(array(striping), v -> v IS NOT NULL)"), "alignment": ("misalignment", "jumps")}
#: Checks whose rules ask for neighbours: of all points within a metre, and of bright or noisy points within two.
NEAR, WIDE = ("outliers", "blooming", "class_noise", "edge_class"), ("ghosting", "noise_points")


def tile_statistics(points: DataFrame, key: str, cell: float = 1.0, centre: float = 0.5, low: float = 0.5) -> DataFrame:
    """One row a tile with all that the rules ask for but neighbours, written: a pass for boxes, means and quantiles, and one by cells."""
    c = F.col("classification")
    ends = [*(f(a).alias(a + side) for a in "xy" for f, side in ((F.min, "0"), (F.max, "1"))), F.min("z").alias("z0"), *(F.avg(a).alias(f"m{a}") for a in "xyz")]
    counts = [F.count("*").alias("points"), *(F.count_if(c == v).alias(f"n{v}") for v in (2, 3, 4, 5, 6, 7)), *_kinds(), *_angles()]
    cuts = {"gm": ("z", 0.5, "classification = 2"), "cut95": ("intensity", 0.95, None), "cut99": ("intensity", 0.99, None)}
    first = durable(aggregated(points, [key], [*ends, *counts], cuts), "tiles")

    at = in_grid(points, first.select(key, "x0", "x1", "y0", "y1", "z0", "mx", "my", "mz", "gm", "cut95", "cut99"), key, cell)
    middle = F.hypot(F.col("x") - (F.col("x0") + F.col("x1")) / 2, F.col("y") - (F.col("y0") + F.col("y1")) / 2) < centre
    flags = {"central": middle, "bright95": F.col("intensity") > F.col("cut95"), "bright99": F.col("intensity") > F.col("cut99"), **{f"__{k}": w for k, w in _misplaced(low).items()}}
    off = {a: F.col(a) - F.col(f"m{a}") for a in "xyz"}
    sums = {f"s{a}{b}": off[a] * off[b] for a, b in PLANE_SUMS}
    cells = at.groupBy(key, "i", "j", "nx", "ny").agg(F.count("*").alias("n"), *(F.count_if(w).alias(k) for k, w in flags.items()), *(F.sum(v).alias(k) for k, v in sums.items()))
    by_tile = cells.groupBy(key).agg(*cell_statistics(cell), *(F.sum(k).alias(k) for k in (*flags, *sums)))
    return durable(_derived(by_tile.join(first, key)), "tiles")


def _derived(tiles: DataFrame) -> DataFrame:
    """What the rules ask for from a tile's counts and sums."""
    n, wrong = {v: F.col(f"n{v}") for v in (2, 3, 4, 5, 6)}, {k: F.col(f"__{k}") for k in _misplaced(0.0)}
    s = fitted_plane(tiles.withColumn("n", F.col("points"))).drop("n", *(f"s{ab}" for ab in PLANE_SUMS))
    s = s.select("*", F.try_divide("i_edge", "i_centre").alias("intensity_ratio"), (F.col("central") / F.col("points")).alias("centre_share"), *_shares(wrong, n))
    return s.drop("central", *(f"__{k}" for k in wrong))


def whole_tiles(points: DataFrame, key: str, timed: bool = True, cell: float = 1.0, centre: float = 0.5, low: float = 0.5) -> DataFrame:
    """tile_statistics() of tiles of few rows, with striping (the amplitude or null) and jumps (an array), written.

    The points are dealt by tile once and all is told where they are.  Tiles of which a number is unknown or infinite are odd:
    nothing else is told of them.
    """
    rows = points.select(key, *(F.col(a).cast("double").alias(a) for a in "xyz"), F.col("classification").cast("long").alias("classification"), *(F.col(a).cast("double").alias(a) for a in ("intensity", "scan_angle")), *([F.col("gps_time").cast("double").alias("gps_time"), "pid"] if timed else []))
    tell = tilewise.told(cell, centre, low, timed)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups.together(batches, 1):
            yield from tell(batch)

    kinds = [f"`key` {rows.schema[key].dataType.simpleString()}", *(f"{n} bigint" for n in tilewise.WHOLE), *(f"{n} double" for n in tilewise.REAL), "striping double, jumps array<double>, odd boolean"]
    told = groups.dealt(rows, [key]).mapInArrow(body, ", ".join(kinds)).withColumnRenamed("key", key)
    return durable(_derived(told), "tiles")


def near_statistics(points: DataFrame, tiles: DataFrame, key: str, radius: float = 1.0, small: float = 0.5) -> DataFrame:
    """QA-07, 10, 14, 15: one row a tile from one look at all points within radius, and within small."""
    mean = F.try_divide(F.col("points"), (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    cut = tiles.select(key, F.when(F.col("bright99") > 50, F.col("cut99")).alias("__cut"), ((F.col("n2") >= 100) & (F.col("n6") >= 100)).alias("edged"), mean.alias("mean"))
    own = points.join(cut, key).withColumn("lit", F.coalesce(F.col("intensity") > F.col("__cut"), F.lit(False)))

    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        classes, c, marks = _marks(more[1])
        rows, (n, m) = _merged(more[0], rows, *counted(at, rows, marks, radius, small))
        change, _ = _changed(n, classes, c[rows], 10)
        close = m.sum(axis=1)
        of = {v: m[:, classes == v].sum(axis=1) for v in (2, 6)}
        lit, edged, mean_ = (more[i].to_numpy(zero_copy_only=False)[rows] for i in (2, 3, 4))
        crowded = lit & (close / (math.pi * small * small) > 3.0 * np.where(np.isnan(mean_), np.inf, mean_))
        edge = edged & (c[rows] == 6)
        return [[len(rows)], [int((close < 5).sum())], [int(crowded.sum())], [int(change.sum())], *([v] for v in _mixed(of[2][edge], of[6][edge]))]

    told = _summed(around(own, radius, "xyz", [key], ["pid", "classification", "lit", "edged", "mean"], fold, "n bigint, low bigint, regions bigint, changed bigint, edge_points bigint, mixed bigint"), key)
    quality = F.when(F.col("edge_points") > 100, 1.0 - F.col("mixed") / F.col("edge_points"))
    return told.select(key, (F.col("low") / F.col("n")).alias("radius_ratio"), "regions", (F.col("changed") / F.col("n")).alias("noise"), "edge_points", quality.alias("quality"))


def wide_statistics(points: DataFrame, tiles: DataFrame, key: str, radius: float = 2.0, rise: float = 0.5) -> DataFrame:
    """QA-09, 16: one row a tile from one look at what lies around bright and noise points."""
    cut = tiles.select(key, F.when(F.col("bright95") > 10, F.col("cut95")).alias("__cut"), (F.col("n7") >= 10).alias("__many")).where("__many OR __cut IS NOT NULL")
    own = points.join(cut, key).withColumns({"lit": F.coalesce(F.col("intensity") > F.col("__cut"), F.lit(False)), "loud": F.coalesce(F.col("__many") & (F.col("classification") == 7), F.lit(False))})

    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        rows, (n,) = _merged(more[0], rows, *counted(at, rows, np.ones((len(at), 1)), radius))
        lit, loud = (more[i].to_numpy(zero_copy_only=False)[rows] for i in (1, 2))
        return [[_raised(at, rows[lit], n[lit, 0], radius, rise)], [int((loud & (n[:, 0] > 5)).sum())], [int(loud.sum())]]

    told = _summed(around(own, radius, "xyz", [key], ["pid", "lit", "loud"], fold, "candidates bigint, crowded bigint, loud bigint", F.col("lit") | F.col("loud")), key)
    return told.select(key, "candidates", F.try_divide("crowded", "loud").alias("crowded"))


def run_checks(points: DataFrame, key: str, names: Sequence[str] | None = None) -> DataFrame:
    """QA-17: the issues of all checks, or of those named.  pid tells points apart.

    Tiles of few rows are dealt once and told of as a whole; large ones and odd ones take the checks' joins.
    """
    names = list(CHECKS if names is None else names)
    few, rest = groups.parted(points, [key])
    whole = whole_tiles(few, key, "alignment" in names)
    odd = whole.where("odd").select(key)
    whole = whole.where("NOT odd")
    if not odd.isEmpty():
        strange = few.join(odd, key, "left_semi")
        rest = strange if rest is None else rest.unionByName(strange)
    tiles = whole.drop("striping", "jumps", "odd")
    if rest is not None:
        tiles = tiles.unionByName(tile_statistics(rest, key))
    stats = tiles
    for group, found in ((NEAR, near_statistics), (WIDE, wide_statistics)):
        if set(group) & set(names):
            stats = stats.join(durable(found(points, tiles, key), "near"), key, "left")
    out = ruled(stats, key, [n for n in names if n in RULES])
    for name in names:
        if name in TOLD:
            kind, values = TOLD[name]
            found = whole.select(key, F.explode(F.expr(values)).alias("value")).select(key, F.lit(kind).alias("issue_type"), F.lit("error").alias("severity"), "value")
            if rest is not None:
                found = found.unionByName(MORE[name](rest, key))
        elif name in MORE:
            found = MORE[name](points, key)
        else:
            continue
        out = out.unionByName(found.withColumn("check", F.lit(name)))
    return out


def quality_level(density_: Column) -> Column:
    """SF-32."""
    return F.when(density_ >= 8, "QL1").when(density_ >= 2, "QL2").when(density_ >= 0.5, "QL3")


def report(tiles: DataFrame, issues: DataFrame, key: str, metrics: DataFrame) -> DataFrame:
    """AG-22, QA-18: one row a tile: level, counts by severity, sorted issue types; tiles without issues have zeros."""
    n = issues.groupBy(key).agg(*(F.count_if(F.col("severity") == s).alias(f"issues_{s}") for s in SEVERITIES), F.array_join(F.array_sort(F.collect_set("issue_type")), ",").alias("issue_types"))
    out = tiles.join(metrics.select(key, "mean_density"), key, "left").join(n, key, "left")
    out = out.na.fill(0, [f"issues_{s}" for s in SEVERITIES]).na.fill("", ["issue_types"])
    return out.withColumns({"quality_level": quality_level(F.col("mean_density")), "needs_correction": (F.col("issues_error") + F.col("issues_critical")) > 0})


def rule_report(tiles: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """report() where all issues follow from the rules of the named checks: tiles' own columns say it all, so nothing is joined."""
    of = lambda s: F.size(F.filter("__i", lambda i: i["severity"] == s)).cast("long")
    types = F.array_join(F.array_sort(F.array_distinct(F.transform("__i", lambda i: i["issue_type"]))), ",")
    out = tiles.withColumn("__i", found_by(names)).select(key, "mean_density", *(of(s).alias(f"issues_{s}") for s in SEVERITIES), types.alias("issue_types"))
    return out.withColumns({"quality_level": quality_level(F.col("mean_density")), "needs_correction": (F.col("issues_error") + F.col("issues_critical")) > 0})


def summary(reports: DataFrame) -> DataFrame:
    """AG-23."""
    return reports.agg(F.count("*").alias("tiles"), F.count_if("needs_correction").alias("to_correct"), F.avg("mean_density").alias("mean_density"), *(F.count_if(F.col("quality_level") == q).alias(q.lower()) for q in ("QL1", "QL2", "QL3")), *(F.sum(f"issues_{s}").alias(f"issues_{s}") for s in SEVERITIES))


def issue_frequency(reports: DataFrame) -> DataFrame:
    """AG-23, SF-06."""
    return reports.where("issue_types <> ''").select(F.explode(F.split("issue_types", ",")).alias("issue_type")).groupBy("issue_type").agg(F.count("*").alias("n"))


def listed(reports: DataFrame, key: str, pattern: str | None = None, severity: str | None = None, most: int = 20) -> DataFrame:
    """PF-13, SL-03: tiles to correct that match, the worst first.  The limit is the feature."""
    out = reports.where("needs_correction")
    if pattern:
        out = out.where(F.col("issue_types").rlike(pattern))
    if severity:
        out = out.where(F.col(f"issues_{severity}") > 0)
    total = F.col("issues_warning") + F.col("issues_error") + F.col("issues_critical")
    return out.withColumn("total_issues", total).orderBy(F.desc("total_issues"), key).limit(most)


def dense_noise(points: DataFrame, key: str, eps: float, least: int) -> DataFrame:
    """PC-21: points kept by density clustering in two dimensions: core points and those within eps of one."""
    def fold(at: np.ndarray, rows: np.ndarray, more: list[pa.Array]) -> list:
        # all within eps of a row have theirs within twice that of it, so they are told to be core points or not as they are
        every, (n,) = _merged(more[0], np.arange(len(at)), *counted(at, np.arange(len(at)), np.ones((len(at), 1)), eps))
        core = np.zeros((len(at), 1))
        core[every[n[:, 0] >= least]] = 1.0
        rows, (kept,) = _merged(more[0], rows, *counted(at, rows, core, eps))
        return [more[0].take(pa.array(rows[kept[:, 0] > 0]))]

    return around(points, 2 * eps, "xy", [key], ["pid"], fold, f"pid {points.schema['pid'].dataType.simpleString()}")


def ranked_sample(df: DataFrame, n: int, key: str, seed: int = 7) -> DataFrame:
    """SL-05: n rows by the hash of a key: the same ones whatever the partitions."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)

