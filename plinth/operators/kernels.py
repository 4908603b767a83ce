"""Iterative kernels on one raster, footprint or clip at a time: NumPy within applyInPandas.

Their groups are bounded by one footprint or one raster, a row a cell, not by the points or the collection; the
cloth checks the size of its raster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def labels_of(mask: np.ndarray, eight: bool) -> np.ndarray:
    """Components of a mask from 1 on in order of their first pixel; 0 outside.

    Pixels are taken in runs of a row; runs of neighbouring rows that touch are hung under the first of them until
    nothing changes, so the work goes by runs and not by pixels.
    """
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    out = np.zeros(mask.shape, dtype=np.int32)
    if not len(row):
        return out
    width, reach = mask.shape[1] + 3, 1 if eight else 0
    below = (row + 1) * width
    first = np.searchsorted(row * width + end, below + start - reach, side="right")
    last = np.searchsorted(row * width + start, below + end + reach, side="left")
    n = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
    root = np.arange(len(row))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            break
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(up := root[root], root):
            root = up
    label = np.unique(root, return_inverse=True)[1] + 1
    step = np.zeros(mask.size + 1, dtype=np.int64)
    at = row * mask.shape[1]
    np.add.at(step, at + start, label)
    np.add.at(step, at + end, -label)
    return np.cumsum(step[:-1]).reshape(mask.shape).astype(np.int32)


def nearest_valid(valid: np.ndarray, v: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the valid pixel nearest to each pixel (v, u); of equally near ones the first row by row.

    One pass finds the nearest valid pixel of each column, above and below; then columns are tried outwards until no
    farther one can be nearer.  valid must have a pixel.
    """
    h, w = valid.shape
    rows = np.arange(h)[:, None]
    above = np.maximum.accumulate(np.where(valid, rows, -1), axis=0)
    below = np.minimum.accumulate(np.where(valid, rows, h)[::-1], axis=0)[::-1]
    best = np.full(len(v), np.iinfo(np.int64).max)
    left = np.arange(len(v))
    for off in range(w):
        left = left[off * off <= best[left] // (h * w)]
        if not len(left):
            break
        for side in (-off, off) if off else (0,):
            x = u[left] + side
            inside = left[(x >= 0) & (x < w)]
            x = u[inside] + side
            for near in (above, below):
                y = near[v[inside], x].astype(np.int64)
                there = (y >= 0) & (y < h)
                key = ((y - v[inside]) ** 2 + off * off) * (h * w) + y * w + x
                best[inside] = np.where(there, np.minimum(best[inside], key), best[inside])
    at = best % (h * w)
    return at // w, at % w


def fill_holes(raster: np.ndarray, nodata: float, most: int = 10) -> np.ndarray:
    """RS-06: 4-connected holes of up to most pixels take the nearest valid pixel's value (row by row if tied)."""
    out, hole = raster.copy(), raster == nodata
    if hole.all() or not hole.any():
        return out
    label = labels_of(hole, eight=False)
    size = np.bincount(label.ravel())
    v, u = np.nonzero((label > 0) & (size[label] <= most))
    if not len(v):
        return out
    out[v, u] = raster[nearest_valid(~hole, v, u)]
    return out


def resize(raster: np.ndarray, shape: tuple[int, int], nodata: float, order: int = 1) -> np.ndarray:
    """RS-07: bilinear (or nearest) resampling; where a valid and a missing pixel mix, the nearest decides."""
    h, w = raster.shape
    v = np.clip((np.arange(shape[0]) + 0.5) * h / shape[0] - 0.5, 0, h - 1)
    u = np.clip((np.arange(shape[1]) + 0.5) * w / shape[1] - 0.5, 0, w - 1)
    near = raster[np.ix_(np.rint(v).astype(int), np.rint(u).astype(int))]
    if order == 0:
        return near
    v0, u0 = np.floor(v).astype(int), np.floor(u).astype(int)
    v1, u1 = np.minimum(v0 + 1, h - 1), np.minimum(u0 + 1, w - 1)
    fv, fu = (v - v0)[:, None], (u - u0)[None, :]
    parts = [raster[np.ix_(a, b)] for a in (v0, v1) for b in (u0, u1)]
    smooth = (parts[0] * (1 - fu) + parts[1] * fu) * (1 - fv) + (parts[2] * (1 - fu) + parts[3] * fu) * fv
    return np.where(np.any([p == nodata for p in parts], axis=0), near, smooth)


def nearest_ground(classes: np.ndarray, elevation: np.ndarray, x: float, y: float, nodata: float, least: int = 5) -> float | None:
    """RS-10: median elevation of the 8-connected ground component of least pixels or more that is nearest to (x, y)."""
    label = labels_of(classes == 2, eight=True)
    size = np.bincount(label.ravel())
    v, u = np.nonzero((label > 0) & (size[label] >= least))
    if not len(v):
        return None
    best = label[v[k := int(np.argmin((u - x) ** 2 + (v - y) ** 2))], u[k]]
    values = elevation[(label == best) & (elevation != nodata)]
    return float(np.median(values)) if len(values) else None


def hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """GE-08: counter-clockwise corners of the convex hull, collinear points left out."""
    points = np.unique(np.stack([x, y], axis=1), axis=0)
    if len(points) < 3:
        return points

    def half(rows) -> list:
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1]))


def simplify(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """GE-07: Douglas-Peucker on a closed ring that starts at its first point."""
    path = np.vstack([ring, ring[:1]])
    keep = np.zeros(len(path), dtype=bool)
    keep[[0, -1]] = True
    stack = [(0, len(path) - 1)]
    while stack:
        a, b = stack.pop()
        if b <= a + 1:
            continue
        p, q, mid = path[a], path[b], path[a + 1 : b]
        d = q - p
        length = float(np.hypot(*d))
        away = np.abs(d[0] * (mid[:, 1] - p[1]) - d[1] * (mid[:, 0] - p[0])) / length if length else np.hypot(*(mid - p).T)
        k = int(np.argmax(away))
        if away[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return path[keep][:-1]


def simplified(rings: DataFrame, tolerance: float) -> DataFrame:
    """GE-07: rings with ring simplified; a ring that would keep fewer than three corners stays as it is."""
    from pyspark.sql import functions as F

    @F.pandas_udf("array<struct<x: double, y: double>>")
    def fewer(ring: pd.Series) -> pd.Series:
        def one(r) -> list:
            path = np.array([(p["x"], p["y"]) for p in r])
            kept = simplify(path, tolerance) if len(path) > 3 else path
            return [{"x": float(x), "y": float(y)} for x, y in (kept if len(kept) > 2 else path)]

        return pd.Series([one(r) for r in ring])

    return rings.withColumn("ring", fewer("ring"))


def cloth_surface(i: np.ndarray, j: np.ndarray, top: np.ndarray, rounds: int = 500, gravity: float = 0.2, tick: float = 0.65, stiffness: int = 3, slope: float | None = 0.3) -> np.ndarray:
    """PC-02: heights, at the cells (i, j) from 0 on, of a cloth that fell on the raster of inverted heights top.

    After the published cloth simulation filter (Zhang et al. 2016) with its step for steep slopes: a cell that still
    hangs beside one that lies, where the two heights below differ by less than slope, lies too (None: no such step).
    """
    shape = (i.max() + 1, j.max() + 1)
    floor_ = np.full(shape, -np.inf)
    np.maximum.at(floor_, (i, j), top)
    seen = np.isfinite(floor_)
    v, u = np.nonzero(~seen)
    floor_[v, u] = floor_[nearest_valid(seen, v, u)]
    # flat, so that neighbours along both axes are shifts; of a pair, each side's share of the gap (halved twice where both are free)
    n, ground = shape[0] * shape[1], floor_.ravel()
    cloth = np.full(n, top.max() + 0.05)
    last, fixed, lying = cloth.copy(), np.zeros(n, dtype=bool), -1
    gap, part, pull, ends = np.empty(n), np.empty(n), np.empty(n), np.arange(n - 1) % shape[1] == shape[1] - 1
    for _ in range(rounds):
        if lying != (lying := int(np.count_nonzero(fixed))):
            shares = []
            for axis, by in enumerate((shape[1], 1)):
                free_a, free_b = ~fixed[: max(n - by, 0)], ~fixed[by:]
                share = np.where(free_a & free_b, 0.125, 0.25)
                if axis:
                    share[ends] = 0.0
                shares.append((by, max(n - by, 0), np.where(free_a, share, 0.0), np.where(free_b, share, 0.0)))
        step = np.where(fixed, 0.0, (cloth - last) * 0.99 - gravity * tick * tick)
        last, cloth = cloth, cloth + step
        for _ in range(stiffness):
            for by, m, share_a, share_b in shares:
                np.subtract(cloth[by:], cloth[:m], out=gap[:m])
                np.multiply(gap[:m], share_a, out=pull[:m])
                pull[m:] = 0.0
                np.multiply(gap[:m], share_b, out=part[:m])
                pull[by:] -= part[:m]
                cloth += pull
        fixed |= cloth <= ground
        np.maximum(cloth, ground, out=cloth)
        if np.abs(cloth - last).max() < 0.005:
            break
    cloth, fixed = cloth.reshape(shape), fixed.reshape(shape)
    while slope is not None:
        laid = np.zeros(shape, dtype=bool)
        for axis in (0, 1):
            near = np.abs(np.diff(floor_, axis=axis)) < slope
            a, b = [slice(None)] * 2, [slice(None)] * 2
            a[axis], b[axis] = slice(None, -1), slice(1, None)
            laid[tuple(a)] |= near & fixed[tuple(b)]
            laid[tuple(b)] |= near & fixed[tuple(a)]
        laid &= ~fixed
        if not laid.any():
            break
        cloth, fixed = np.where(laid, floor_, cloth), fixed | laid
    return cloth[i, j]


def grouped(df: DataFrame, key: str, body, schema: str) -> DataFrame:
    """body(pandas frame) for each key."""
    return df.groupBy(key).applyInPandas(body, schema)


#: Cells of one cloth; a larger raster is refused, since a clip or tile is what the filter is for.
CLOTH_CELLS = 1 << 24


def ground_points(points: DataFrame, key: str, resolution: float = 1.0, threshold: float = 0.5, k: int = 8, factor: float = 2.0) -> DataFrame:
    """PC-02: ground class, statistical outliers out, cloth simulation.  points: key, pid, x, y, z, classification.

    Neighbours and the raster's highest values are Spark's; one raster, a row a cell, reaches one task.
    """
    from pyspark.sql import functions as F

    from .qa import neighbour_distances
    from .spatial import spread

    ground = points.where("classification = 2").select(key, "pid", "x", "y", "z")
    outside = neighbour_distances(ground, key, k, factor).where("d > limit").select(key, "pid")
    inner = ground.join(outside, [key, "pid"], "left_anti")
    box = inner.groupBy(key).agg(F.min("x").alias("__x"), F.min("y").alias("__y"))
    index = lambda v, lo: F.floor((F.col(v) - F.col(lo)) / resolution).cast("int")
    at = inner.join(box, key).withColumns({"i": index("x", "__x"), "j": index("y", "__y")}).drop("__x", "__y")
    cells = at.groupBy(key, "i", "j").agg(F.max(-F.col("z")).alias("top"))
    kind = points.schema[key].dataType.simpleString()

    def fall(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["i", "j"])
        if (int(pdf["i"].max()) + 1) * (int(pdf["j"].max()) + 1) > CLOTH_CELLS:
            raise ValueError("a raster too large for one cloth: clip the points or take a coarser resolution")
        return pdf[[key, "i", "j"]].assign(cloth=cloth_surface(pdf["i"].to_numpy(), pdf["j"].to_numpy(), pdf["top"].to_numpy()))

    cloth = grouped(spread(cells, key), key, fall, f"{key} {kind}, i int, j int, cloth double")
    return at.join(cloth, [key, "i", "j"]).where(F.abs(-F.col("z") - F.col("cloth")) <= threshold).select(key, "pid", "x", "y", "z")
