"""Cameras that see the edges of footprints, told where edges and cameras of a cell meet.

Edges lie in one cell each and cameras are copied to the cells that their disc touches; both travel packed, and pairs are
made in NumPy, some at a time, so that only those that count leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..config import VIEWS
from . import groups

#: Pairs at once; rows of a cell, of either side, that travel together.
PAIRS, HELD = 1 << 16, 1 << 13
#: Types by number, as functions.geo.view_type() names them.
TYPES = ("direct", "semi_oblique_left", "semi_oblique_right", "oblique_left", "oblique_right")


def view_types(angle: np.ndarray) -> np.ndarray:
    """The number of each angle's type, -1 between them."""
    e, (s0, s1), (o0, o1) = VIEWS.eps, VIEWS.semi, VIEWS.oblique
    inside = lambda lo, hi: (angle >= lo - e) & (angle <= hi + e)
    return np.select([np.abs(angle) <= VIEWS.direct + e, inside(s0, s1), inside(-s1, -s0), inside(o0, o1), inside(-o1, -o0)], range(5), -1)


class _Rings:
    """Rings of a column, for tests of points with few of them."""

    def __init__(self, column: pa.Array) -> None:
        self.size = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        corners = column.flatten()
        self.x, self.y = (corners.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y"))
        self.start = np.cumsum(self.size) - self.size
        self.box = np.full((len(self.size), 4), np.nan)
        some = self.size > 0
        if some.any():
            at = self.start[some]
            self.box[some] = np.stack([f.reduceat(v, at) for f in (np.minimum, np.maximum) for v in (self.x, self.y)], axis=1)

    def hold(self, of: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the ring of holds the point x, y: geo.contains() of those that lie in its box."""
        x0, y0, x1, y1 = self.box.T
        out = (x >= x0[of]) & (x <= x1[of]) & (y >= y0[of]) & (y <= y1[of])
        for i in np.flatnonzero(out):
            own = slice(self.start[of[i]], self.start[of[i]] + self.size[of[i]])
            ax, ay = self.x[own], self.y[own]
            bx, by = np.roll(ax, -1), np.roll(ay, -1)
            cut = (ay > y[i]) != (by > y[i])
            out[i] = (x[i] < (bx[cut] - ax[cut]) * ((y[i] - ay[cut]) / (by[cut] - ay[cut])) + ax[cut]).sum() % 2
        return out


def _pairs(edges: pa.StructArray, cameras: pa.StructArray, radius: float) -> Iterator[tuple[np.ndarray, ...]]:
    """edge, camera, type, distance, angle of the views, by blocks of edges: an edge has all its views of these cameras in one."""
    number = lambda rows, c: rows.field(c).to_numpy(zero_copy_only=False).astype(float)
    mx, my, nx, ny = (number(edges, c) for c in ("mx", "my", "nx", "ny"))
    px, py = number(cameras, "px"), number(cameras, "py")
    order = np.argsort(px, kind="stable")
    px, py, rings = px[order], py[order], _Rings(edges.field("ring"))
    # of the half of the disc before the edge; rounding must not lose a pair at its border
    reach, beside = radius * (1 + 1e-9), np.abs(ny) * (1 + 1e-9)
    least = np.searchsorted(px, mx - reach * np.where(nx > 0, beside, 1.0))
    n = np.maximum(np.searchsorted(px, mx + reach * np.where(nx < 0, beside, 1.0), side="right") - least, 0)
    ends, lo, steep = np.append(0, np.cumsum(n)), 0, math.tan(math.radians(min(89.9, VIEWS.oblique[1] + 1e-3)))
    while lo < len(mx):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PAIRS, side="right")) - 1)
        e = np.repeat(np.arange(lo, hi), n[lo:hi])
        c = np.arange(ends[lo], ends[hi]) - np.repeat(ends[lo:hi] - least[lo:hi], n[lo:hi])
        lo = hi
        vx, vy = px[c] - mx[e], py[c] - my[e]
        d2 = vx * vx + vy * vy
        ok = np.flatnonzero(d2 <= radius * radius)
        e, c, vx, vy, d2 = e[ok], c[ok], vx[ok], vy[ok], d2[ok]
        u, v = nx[e], ny[e]
        ahead, aside = u * vx + v * vy, u * vy - v * vx
        ok = np.flatnonzero((ahead > 0) & (np.abs(aside) <= steep * ahead))
        angle = np.degrees(np.arctan2(aside[ok], ahead[ok]))
        kind = view_types(angle)
        typed = kind >= 0
        e, c, d2, kind, angle = e[ok][typed], c[ok][typed], d2[ok][typed], kind[typed], angle[typed]
        out = ~rings.hold(e, px[c], py[c])
        if out.any():
            yield e[out], order[c[out]], kind[out], np.sqrt(d2[out]), angle[out]


class _Walls:
    """The walls (bid, ax..by) around the edges of a cell; a building's own walls and those of buildings in its edges' list beside do not count."""

    def __init__(self, walls: pa.StructArray, edges: pa.StructArray) -> None:
        number = lambda rows, c: rows.field(c).to_numpy(zero_copy_only=False).astype(float)
        ends = [number(walls, c) for c in ("ax", "ay", "bx", "by")]
        order = np.argsort(np.minimum(ends[0], ends[2]), kind="stable")
        self.ax, self.ay, self.bx, self.by = (v[order] for v in ends)
        self.x0, self.x1 = np.minimum(self.ax, self.bx), np.maximum(self.ax, self.bx)
        self.y0, self.y1 = np.minimum(self.ay, self.by), np.maximum(self.ay, self.by)
        self.longest = (self.x1 - self.x0).max(initial=0.0)
        beside = edges.field("beside")
        names = pa.concat_arrays([walls.field("bid"), edges.field("id"), beside.flatten()]).to_numpy(zero_copy_only=False)
        codes = np.unique(names, return_inverse=True)[1]
        self.n = codes.max(initial=0) + 1
        self.bid = codes[: len(walls)][order]
        own, others = codes[len(walls) : len(walls) + len(edges)], codes[len(walls) + len(edges) :]
        of = np.repeat(np.arange(len(edges)), beside.value_lengths().fill_null(0).to_numpy())
        self.left_out = np.unique(np.concatenate([np.arange(len(edges)) * self.n + own, of * self.n + others]))
        self.mx, self.my = number(edges, "mx"), number(edges, "my")

    def _near(self, e: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Place in e, wall: those that count and come within reach of the edge's midpoint, over each axis."""
        first = np.searchsorted(self.x0, self.mx[e] - reach - self.longest)
        n = np.searchsorted(self.x0, self.mx[e] + reach, side="right") - first
        ends, lo, out = np.append(0, np.cumsum(n)), 0, []
        while lo < len(e):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PAIRS, side="right")) - 1)
            at = np.repeat(np.arange(lo, hi), n[lo:hi])
            w = np.arange(ends[lo], ends[hi]) - np.repeat(ends[lo:hi] - first[lo:hi], n[lo:hi])
            lo = hi
            mx, my = self.mx[e[at]], self.my[e[at]]
            ok = (self.x1[w] >= mx - reach) & (self.y1[w] >= my - reach) & (self.y0[w] <= my + reach)
            at, w = at[ok], w[ok]
            key = e[at] * self.n + self.bid[w]
            ok = self.left_out[np.minimum(np.searchsorted(self.left_out, key), len(self.left_out) - 1)] != key
            out.append((at[ok], w[ok]))
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))

    def block(self, e: np.ndarray, px: np.ndarray, py: np.ndarray, radius: float, slack: float) -> np.ndarray:
        """Whether a wall crosses the ray from P to the edge's midpoint more than slack before it.  Walls near the midpoint come first, as most rays end there."""
        blocked, reach = np.zeros(len(e), dtype=bool), 1.0
        while True:
            ray = np.flatnonzero(~blocked)
            if not len(ray) or not len(self.bid):
                return blocked
            reach = min(reach, radius * (1 + 1e-9))
            own, place = np.unique(e[ray], return_inverse=True)
            at, wall = self._near(own, reach)
            n = np.bincount(at, minlength=len(own))
            first, n = (np.cumsum(n) - n)[place], n[place]
            ends, lo = np.append(0, np.cumsum(n)), 0
            while lo < len(ray):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PAIRS, side="right")) - 1)
                r = np.repeat(ray[lo:hi], n[lo:hi])
                w = wall[np.arange(ends[lo], ends[hi]) - np.repeat(ends[lo:hi] - first[lo:hi], n[lo:hi])]
                lo = hi
                rx, ry, sx, sy = self.mx[e[r]] - px[r], self.my[e[r]] - py[r], self.bx[w] - self.ax[w], self.by[w] - self.ay[w]
                dx, dy = self.ax[w] - px[r], self.ay[w] - py[r]
                with np.errstate(divide="ignore", invalid="ignore"):
                    cross = rx * sy - ry * sx
                    t, u = (dx * sy - dy * sx) / cross, (dx * ry - dy * rx) / cross
                length = np.hypot(rx, ry)
                blocked[r[(cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1) & (t * length + slack < length)]] = True
            if reach >= radius:
                return blocked
            reach *= 2


Made = Callable[..., dict[str, pa.Array]]


def meeting(edges: DataFrame, cameras: DataFrame, radius: float, made: Made, kinds: str, walls: DataFrame | None = None) -> DataFrame:
    """What made(edges, cameras, views) makes of the views of each block; edges as of ringed_edges(), cameras with pano_id, px, py.

    walls (bid, ax..by): made() gets those within radius of the cell too.
    """
    from .spatial import cell_of, cells_over, spread

    at, size, reach = ["__c0", "__c1"], 2.0 * radius, radius * (1 + 1e-9)
    near = cameras
    for k, a in zip(at, ("px", "py"), strict=True):
        near = near.withColumn(k, F.explode(cells_over(F.col(a) - reach, F.col(a) + reach, size)))
    far = edges.withColumns({k: cell_of(F.col(o), size) for k, o in zip(at, ("mx", "my"), strict=True)})
    packs = lambda rows: spread(groups.packed(spread(rows, *at).sortWithinPartitions(*at), at, HELD), *at)
    met = packs(near).withColumnRenamed("rows", "cameras").join(packs(far).withColumnRenamed("rows", "edges").hint("merge"), at)
    blind = walls is None
    if not blind:
        for k, (a, b) in zip(at, (("ax", "bx"), ("ay", "by")), strict=True):
            walls = walls.withColumn(k, F.explode(cells_over(F.least(a, b) - reach, F.greatest(a, b) + reach, size)))
        around = spread(walls, *at).groupBy(*at).agg(F.collect_list(F.struct("bid", "ax", "ay", "bx", "by")).alias("walls"))
        met = met.join(around.hint("merge"), at)  # edges have walls of their own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                seen, by = batch.column("edges")[n].values, batch.column("cameras")[n].values
                rest = () if blind else (_Walls(batch.column("walls")[n].values, seen),)
                for views in _pairs(seen, by, radius):
                    yield pa.RecordBatch.from_pydict(made(seen, by, views, *rest))

    return met.mapInArrow(run, kinds)


def candidates(edges: DataFrame, cameras: DataFrame, radius: float, columns: Sequence[str]) -> DataFrame:
    """A row a view with some of id, edge_idx, pano_id, view_type, distance, angle, mx, my, px, py."""
    of_edge, of_camera, types = {"id", "edge_idx", "mx", "my"}, {"pano_id", "px", "py"}, pa.array(TYPES)

    def made(seen: pa.StructArray, by: pa.StructArray, views: tuple[np.ndarray, ...]) -> dict[str, pa.Array]:
        e, c, kind, distance, angle = views
        own = {"view_type": lambda: types.take(pa.array(kind)), "distance": lambda: pa.array(distance), "angle": lambda: pa.array(angle)}
        return {k: seen.field(k).take(pa.array(e)) if k in of_edge else by.field(k).take(pa.array(c)) if k in of_camera else own[k]() for k in columns}

    kinds = {"view_type": "string", "distance": "double", "angle": "double"} | {f.name: f.dataType.simpleString() for df in (edges, cameras) for f in df.schema}
    return meeting(edges, cameras, radius, made, ", ".join(f"`{k}` {kinds[k]}" for k in columns))


def nearest(edges: DataFrame, cameras: DataFrame, radius: float) -> DataFrame:
    """id, edge_idx, view_type, distance, pano_id: the nearest camera of each edge and type, ties to the smaller pano_id.

    Tasks keep the nearest of a pack of cameras; of several packs of a cell the nearest is taken after.
    """
    types = pa.array(TYPES)

    def made(seen: pa.StructArray, by: pa.StructArray, views: tuple[np.ndarray, ...]) -> dict[str, pa.Array]:
        e, c, kind, distance, _ = views
        names = by.field("pano_id").to_numpy(zero_copy_only=False)[c]
        group = e * len(TYPES) + kind
        order = np.lexsort((distance, group))
        low = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
        least = np.repeat(distance[order][low], np.diff(np.append(low, len(order))))
        tied = order[distance[order] == least]  # one for most groups
        tied = tied[np.lexsort((np.unique(names[tied], return_inverse=True)[1], group[tied]))]
        best = tied[np.append(True, group[tied][1:] != group[tied][:-1])]
        return {"id": seen.field("id").take(pa.array(e[best])), "edge_idx": seen.field("edge_idx").take(pa.array(e[best])), "view_type": types.take(pa.array(kind[best])), "distance": pa.array(distance[best]), "pano_id": by.field("pano_id").take(pa.array(c[best]))}

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    found = meeting(edges, cameras, radius, made, f"id {kind(edges, 'id')}, edge_idx {kind(edges, 'edge_idx')}, view_type string, distance double, pano_id {kind(cameras, 'pano_id')}")
    return found.groupBy("id", "edge_idx", "view_type").agg(F.min(F.struct("distance", "pano_id")).alias("b")).select("id", "edge_idx", "view_type", "b.distance", "b.pano_id")


def unblocked(edges: DataFrame, cameras: DataFrame, walls: DataFrame, radius: float, slack: float = VIEWS.occlusion_slack) -> DataFrame:
    """JN-08: id, edge_idx, pano_id of the views whose ray no wall (bid, ax..by) of another building crosses more than slack before
    the edge; those of buildings in beside, a list that edges bring, do not count.  Rays are made and tested in one task."""

    def made(seen: pa.StructArray, by: pa.StructArray, views: tuple[np.ndarray, ...], around: _Walls) -> dict[str, pa.Array]:
        e, c = views[:2]
        px, py = (by.field(k).to_numpy(zero_copy_only=False).astype(float)[c] for k in ("px", "py"))
        free = np.flatnonzero(~around.block(e, px, py, radius, slack))
        return {k: seen.field(k).take(pa.array(e[free])) for k in ("id", "edge_idx")} | {"pano_id": by.field("pano_id").take(pa.array(c[free]))}

    kinds = {f.name: f.dataType.simpleString() for df in (edges, cameras) for f in df.schema}
    return meeting(edges, cameras, radius, made, ", ".join(f"{k} {kinds[k]}" for k in ("id", "edge_idx", "pano_id")), walls)
