"""Overlaps of any simple rings, many pairs at once.

The area that two rings share is an integral along its border: the pieces of each ring's edges that lie inside the
other one.  Edges are cut where they meet the other ring, and a piece counts if its middle lies inside; of a border that
both rings share, the part where they run the same way counts once.  Rings whose edges all follow the axes are cut into
boxes once each, and what two of them share is what their boxes do.

Pairs are made where they are compared: shared_areas() deals rings by cell and pairs do not leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..tables import durable
from . import groups

#: Edge pairs that are held at once, and what share of a pair's extent counts as touching.
CELLS, TOUCH = 1 << 21, 1e-10
#: Pairs of boxes at once; corners up to which a ring is cut into boxes; rings of a cell that are compared at once.
PAIRS, CORNERS, HELD = 1 << 16, 32, 1 << 13


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All corners of a column of rings; where each ring begins, and its number of corners (null: none)."""
    size = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    corners = column.flatten()
    xy = np.stack([corners.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y")], axis=1)
    return xy, np.cumsum(size) - size, size


def _padded(xy: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rings of one width, counter-clockwise; the first corner is repeated, which adds edges without length."""
    at = np.arange(size.max())
    ring = xy[start[:, None] + np.where(at < size[:, None], at, 0)]
    wrong = _cross(ring - ring[:, :1], np.roll(ring, -1, axis=1) - ring[:, :1]).sum(axis=1) < 0
    back = xy[start[:, None] + np.where(at < size[:, None], size[:, None] - 1 - at, size[:, None] - 1)]
    return np.where(wrong[:, None, None], back, ring)


def _pieces(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of the edges of a, cut where they meet b: pair, direction, and begin, end and middle."""
    p, r = a, np.roll(a, -1, axis=1) - a
    u, s = b, np.roll(b, -1, axis=1) - b
    off = u[:, None] - p[:, :, None]
    turn = _cross(r[:, :, None], s[:, None])
    length2 = (r * r).sum(axis=-1)[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t, v = _cross(off, s[:, None]) / turn, _cross(off, r[:, :, None]) / turn
        meets = (turn != 0) & (t > 0) & (t < 1) & (v >= 0) & (v <= 1)
        along = (off * r[:, :, None]).sum(axis=-1) / length2
        # corners of b on the edge: where borders run together, they begin or end there
        touches = (np.abs(_cross(off, r[:, :, None])) <= near[:, None, None] * np.sqrt(length2)) & (along > 0) & (along < 1)
    cuts = np.concatenate([np.zeros((*p.shape[:2], 1)), np.where(meets, t, 1.0), np.where(touches, along, 1.0), np.ones((*p.shape[:2], 1))], axis=2)
    cuts.sort(axis=2)
    pair, edge, k = np.nonzero((cuts[..., 1:] > cuts[..., :-1]) & (length2 > 0))
    lo, hi = cuts[pair, edge, k], cuts[pair, edge, k + 1]
    at, way = p[pair, edge], r[pair, edge]
    return pair, way, at + lo[:, None] * way, at + hi[:, None] * way, at + ((lo + hi) / 2)[:, None] * way


def _sides(pair: np.ndarray, middle: np.ndarray, way: np.ndarray, b: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each piece's middle lies inside b, and whether it lies on an edge of b that runs the same way."""
    inside, shared = np.zeros(len(pair), dtype=bool), np.zeros(len(pair), dtype=bool)
    step = max(1, CELLS // b.shape[1])
    for i in range(0, len(pair), step):
        own = slice(i, i + step)
        u = b[pair[own]]
        v = np.roll(u, -1, axis=1)
        s = v - u
        m = middle[own, None]
        off = m - u
        up = (u[..., 1] > m[..., 1]) != (v[..., 1] > m[..., 1])  # of the corners themselves: u + s may miss v by its last bit, and a ring that does not close tells wrong sides
        with np.errstate(divide="ignore", invalid="ignore"):
            left = off[..., 0] < s[..., 0] * off[..., 1] / s[..., 1]
            length2 = (s * s).sum(axis=-1)
            along = (off * s).sum(axis=-1) / length2
            on = (np.abs(_cross(s, off)) <= near[pair[own], None] * np.sqrt(length2)) & (along >= 0) & (along <= 1) & (length2 > 0)
        same = on & ((way[own, None] * s).sum(axis=-1) > 0)
        inside[own] = ((up & left).sum(axis=1) % 2 == 1) & ~on.any(axis=1)
        shared[own] = same.any(axis=1)
    return inside, shared


def _areas(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What each pair of rings, of one width a side, shares."""
    both = np.concatenate([a, b], axis=1)
    low = both.min(axis=1)
    near = TOUCH * (both.max(axis=1) - low).max(axis=1)
    a, b = a - low[:, None], b - low[:, None]
    total = np.zeros(len(a))
    for own, other, first in ((a, b, True), (b, a, False)):
        pair, way, begin, end, middle = _pieces(own, other, near)
        inside, shared = _sides(pair, middle, way, other, near)
        counts = inside | shared if first else inside
        total += np.bincount(pair[counts], weights=_cross(begin, end)[counts] / 2, minlength=len(a))
    return np.maximum(total, 0.0)


def areas(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The area that two rings of each row share; rings of fewer than three corners (and null) have none."""
    (ax, a0, an), (bx, b0, bn) = _flat(left), _flat(right)
    out = np.zeros(len(left))
    todo = np.flatnonzero((an > 2) & (bn > 2))
    todo = todo[np.lexsort((bn[todo], an[todo]))]  # rings of like size together
    while len(todo):
        n = 1
        while n < len(todo) and (2 * n) * an[todo[: 2 * n]].max() * bn[todo[: 2 * n]].max() <= CELLS:
            n *= 2
        now, todo = todo[:n], todo[n:]
        out[now] = _areas(_padded(ax, a0[now], an[now]), _padded(bx, b0[now], bn[now]))
    return out


def _boxed(xy: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boxes (box, x0 y0 x1 y1, ring) that make up each ring, and whether it has any: its edges follow the axes, its corners are few.

    Rings are cut at all their corners' x; between two of them, edges pair up by their height.
    """
    whole, made = np.zeros(len(size), dtype=bool), []
    for n in np.unique(size[(size > 3) & (size <= CORNERS)]):
        own = np.flatnonzero(size == n)
        step = max(1, CELLS // int(n) ** 2)
        for some in (own[i : i + step] for i in range(0, len(own), step)):
            ring = xy[start[some][:, None] + np.arange(n)]
            after = np.roll(ring, -1, axis=1)
            ok = (ring == after).any(axis=2).all(axis=1) & np.isfinite(ring).all(axis=(1, 2))
            some, ring, after = some[ok], ring[ok], after[ok]
            whole[some] = True
            x = np.sort(ring[..., 0], axis=1)
            lo, hi = np.minimum(ring, after)[..., 0], np.maximum(ring, after)[..., 0]
            # an upright edge spans nothing
            over = (lo[:, None] <= x[:, :-1, None]) & (hi[:, None] >= x[:, 1:, None]) & (x[:, :-1] < x[:, 1:])[..., None]
            y = np.sort(np.where(over, ring[:, None, :, 1], np.inf), axis=2)[..., : n // 2 * 2].reshape(len(some), n - 1, n // 2, 2)
            at, slab, k = np.nonzero(np.isfinite(y[..., 1]) & (y[..., 0] < y[..., 1]))
            made.append((some[at], np.stack([x[at, slab], y[at, slab, k, 0], x[at, slab + 1], y[at, slab, k, 1]], axis=1)))
    of = np.concatenate([np.zeros(0, dtype=np.int64), *(m[0] for m in made)])
    n = np.bincount(of, minlength=len(size))
    order = np.argsort(of, kind="stable")
    out = np.zeros((n.max(initial=0), 4, len(size)))
    out[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), :, of[order]] = np.concatenate([np.zeros((0, 4)), *(m[1] for m in made)])[order]
    return out, whole


def _boxes_shared(boxes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the boxes (box, corner, ring) of rings a and b share; those of one ring share nothing."""
    total = np.zeros(len(a))
    right = [[side[b] for side in box] for box in boxes]
    for box in boxes:
        x0, y0, x1, y1 = (side[a] for side in box)
        for u0, v0, u1, v1 in right:
            wide, high = np.minimum(x1, u1), np.minimum(y1, v1)
            wide -= np.maximum(x0, u0)
            high -= np.maximum(y0, v0)
            np.maximum(wide, 0.0, out=wide)
            np.maximum(high, 0.0, out=high)
            wide *= high
            total += wide
    return total


def _meeting(box: np.ndarray, cells: np.ndarray, rank: np.ndarray, side: np.ndarray | None, here: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (left, right) of the cell here whose boxes meet, the left one of the smaller rank, in blocks; of the cells that both
    lie in (cells: the first of each box), the first one has the pair.  side: what must differ too."""
    order = np.argsort(box[:, 0], kind="stable")
    x0, y0, x1, y1 = box[order].T.copy()
    rank, side, (own_i, own_j) = rank[order], None if side is None else side[order], (cells[order] == here).T.copy()
    # those that begin after it, before it ends
    n = np.maximum(np.searchsorted(x0, x1, side="right") - np.arange(len(x0)) - 1, 0)
    ends = np.append(0, np.cumsum(n))
    lo = 0
    while lo < len(x0):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PAIRS, side="right")) - 1)
        a = np.repeat(np.arange(lo, hi), n[lo:hi])
        b = np.arange(ends[lo], ends[hi]) - np.repeat(ends[lo:hi] - np.arange(lo + 1, hi + 1), n[lo:hi])
        lo = hi
        ok = (y0[a] <= y1[b]) & (y0[b] <= y1[a])
        a, b = a[ok], b[ok]
        ok = (own_i[a] | own_i[b]) & (own_j[a] | own_j[b]) & (rank[a] != rank[b])
        a, b = a[ok], b[ok]
        if side is not None:
            a, b = a[ok := side[a] != side[b]], b[ok]
        turn = rank[a] > rank[b]
        if len(a):
            yield order[np.where(turn, b, a)], order[np.where(turn, a, b)]


def shared_areas(rings: DataFrame, key: str, other: str, cell: float) -> DataFrame:
    """GE-14: key, other, area: pairs of rings (key, ring) whose boxes meet, the smaller key first, with the area that they share.

    Rings are dealt to the cells that their boxes cover and travel packed, up to HELD a row; packs of a cell meet, and a task
    makes the pairs of two packs, some at a time.
    """
    from .spatial import cells_over, spread, with_box

    kind = rings.schema[key].dataType.simpleString()
    held = with_box(spread(rings.select(F.col(key).alias("key"), "ring").where("key IS NOT NULL"), "key"))  # a file of few MB holds many rings
    for k, d in (("__i", "x"), ("__j", "y")):
        held = held.withColumn(k, F.explode(cells_over(F.col(f"{d}0"), F.col(f"{d}1"), cell)))
    at = ["__i", "__j"]
    packs = durable(groups.packed(spread(held, *at).sortWithinPartitions(*at), at, HELD).withColumn("part", F.monotonically_increasing_id()), "packs")
    right = packs.select(*at, F.col("part").alias("other_part"), F.col("rows").alias("other_rows"))
    met = spread(packs, *at).join(spread(right, *at).hint("merge"), at).where("part <= other_part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                here, (part, other_part) = tuple(batch.column(c)[n].as_py() for c in at), (batch.column(c)[n] for c in ("part", "other_part"))
                rows, side = batch.column("rows")[n].values, None
                if part != other_part:
                    more = batch.column("other_rows")[n].values
                    side = np.arange(len(rows) + len(more)) < len(rows)
                    rows = pa.concat_arrays([rows, more])
                keys, ring = rows.field("key"), rows.field("ring")
                box = np.stack([rows.field(c).to_numpy() for c in ("x0", "y0", "x1", "y1")], axis=1)
                rank = np.unique(keys.to_numpy(zero_copy_only=False), return_inverse=True)[1]
                boxes, whole = _boxed(*_flat(ring))
                for a, b in _meeting(box, np.floor(box[:, :2] / cell), rank, side, here):
                    area, plain = np.zeros(len(a)), whole[a] & whole[b]
                    area[plain] = _boxes_shared(boxes, a[plain], b[plain])
                    if not plain.all():
                        area[~plain] = areas(ring.take(pa.array(a[~plain])), ring.take(pa.array(b[~plain])))
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(a)), keys.take(pa.array(b)), pa.array(area)], names=[key, other, "area"])

    return met.mapInArrow(run, f"`{key}` {kind}, `{other}` {kind}, area double")


def with_overlap(pairs: DataFrame, left: str = "ring", right: str = "other", name: str = "area") -> DataFrame:
    """GE-14: pairs with the area that the rings of two columns share, exact for any simple rings in any direction."""
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema), f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(areas(batch.column(left), batch.column(right)))], names=[*batch.schema.names, name])

    return pairs.mapInArrow(run, kinds)
