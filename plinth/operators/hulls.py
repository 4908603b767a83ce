"""Convex hulls of groups of any size: hulls of whole groups of few rows, else hulls of parts, then hulls of hulls.

Of larger groups a task keeps the corners of its rows' hulls alone, and the hulls of a group's tasks meet in two rounds, so that a group
with a third of all rows costs one task no more than the corners of SLOTS hulls.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..functions import geo
from . import groups
from .kernels import hull

#: Rows of a group that one task takes, and groups that it tells of at once.
WHOLE, TOLD = 1 << 18, 1 << 10
#: Tasks' hulls of a group that meet in the first round, by task number; corners that a task holds before it writes them.
SLOTS, HELD = 64, 1 << 20
#: Directions whose farthest points bound an octagon; most points lie inside it.
DIRECTIONS = np.array([[1, 0], [1, 1], [0, 1], [-1, 1], [-1, 0], [-1, -1], [0, -1], [1, -1]], dtype=float)


def corners(xy: np.ndarray) -> np.ndarray:
    """Counter-clockwise corners of the hull of points, n by 2."""
    if len(xy) > 32:
        far = xy[np.unique((xy @ DIRECTIONS.T).argmax(axis=0))]
        ring = hull(far[:, 0], far[:, 1])
        if len(ring) > 2:
            along = np.roll(ring, -1, axis=0) - ring
            inner = np.ones(len(xy), dtype=bool)
            for (px, py), (dx, dy) in zip(ring, along, strict=True):
                inner &= dx * (xy[:, 1] - py) - dy * (xy[:, 0] - px) > 0
            xy = xy[~inner]
    return hull(xy[:, 0], xy[:, 1])


def hulls(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """GE-08, GE-20: by and ring, the corners of the hull of each group's points (x, y).

    A group of one or two places, or on a line, has its ends.  Rows with a null in by, or without coordinates, are in no
    group; without rows there is no hull.  Repeated points change nothing.
    """
    by = list(by)
    known = points.select(*by, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    known = known.dropna()  # NaN too
    keys = by or ["__all"]
    known = known if by else known.select(F.lit(0).alias("__all"), "x", "y")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema)

    def frame(key: tuple, ring: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({**dict(zip(keys, key, strict=True)), "x": ring[:, 0], "y": ring[:, 1]})

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), {}
        for pdf in frames:
            for key, own in pdf.groupby(keys, sort=False):
                xy = own[["x", "y"]].to_numpy()
                held[key] = corners(np.concatenate([held[key], xy]) if key in held else xy)
            if sum(map(len, held.values())) > HELD:
                yield from (frame(k, r).assign(__part=part) for k, r in held.items())
                held = {}
        yield from (frame(k, r).assign(__part=part) for k, r in held.items())

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return frame(key[: len(keys)], corners(pdf[["x", "y"]].to_numpy()))

    def ring_of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ring = [{"x": x, "y": y} for x, y in corners(pdf[["x", "y"]].to_numpy())]
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key, strict=True)}, "ring": [ring]})

    n_by = len(keys)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[pa.RecordBatch] = []
        rings: list[np.ndarray] = []

        def told() -> pa.RecordBatch:
            xy = np.concatenate(rings)
            ends = np.cumsum([0, *map(len, rings)]).astype(np.int32)
            ring = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"]))
            of = pa.Table.from_batches(names).combine_chunks().to_batches()[0]
            names.clear(), rings.clear()
            return pa.RecordBatch.from_arrays([*of.columns, ring], names=[*keys, "ring"])

        for group in groups.runs(batches, n_by):
            names.append(group.slice(0, 1).select(keys))
            rings.append(corners(np.stack([group.column(n_by + i).to_numpy() for i in range(2)], axis=1)))
            if len(rings) == TOLD:
                yield told()
        if rings:
            yield told()

    few, many = groups.parted(known, keys, WHOLE)
    shapes = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema if f.name in keys) + ", ring array<struct<x: double, y: double>>"
    out = groups.dealt(few, keys).mapInArrow(whole, shapes).select(*by, "ring")
    if many is None:
        return out
    parts = many.mapInPandas(local, f"{kinds}, __part int")
    met = parts.groupBy(*keys, F.pmod("__part", F.lit(SLOTS)).alias("__slot")).applyInPandas(merged, kinds)
    return out.unionByName(met.groupBy(*keys).applyInPandas(ring_of, shapes).select(*by, "ring"))


def hull_areas(points: DataFrame, key: str) -> DataFrame:
    """GE-09, PC-05: area and number of corners of the hull of each clip."""
    return hulls(points, [key]).select(key, geo.area(F.col("ring")).alias("convex_hull_area"), F.size("ring").alias("corners"))
