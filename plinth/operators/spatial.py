"""Spatial joins as equi-joins on grid cells with an exact test after.

Both sides are dealt by cell (hint merge): pairs outgrow small files by far, and a broadcast would leave them all to the few
tasks that read the other side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..config import VIEWS
from ..functions import geo
from ..tables import durable
from . import sightlines
from .overlaps import shared_areas


def cell_of(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def cells_over(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(cell_of(lo, size), cell_of(hi, size))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt into as many parts as tasks may run, however few its bytes: what is made of them takes longer than they do."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *by)


def within_distance(left: DataFrame, right: DataFrame, radius: float, axes: Sequence[str], other: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """JN-07/19/20: pairs no farther apart than radius, with their distance.

    Cells lie over the first two axes, since clouds are surfaces, and are two radii wide: the left side is copied to
    the cells that its disc touches (four on average), the right side lies in one cell, so each pair meets once and
    AQE may split a dense cell (without by, cells are spread() instead).  The smaller or narrower side should be the left one.  Columns of the two sides must
    differ, but for those of by, which must be equal.
    """
    size, reach = 2.0 * radius, radius * (1 + 1e-9)  # rounding must not lose a pair at the border of a cell
    keys = [f"__c{i}" for i in range(2)]
    near = left
    for k, a in zip(keys, axes, strict=False):
        near = near.withColumn(k, F.explode(cells_over(F.col(a) - reach, F.col(a) + reach, size)))
    far = right.withColumns({k: cell_of(F.col(o), size) for k, o in zip(keys, other, strict=False)})
    d2 = sum(((F.col(a) - F.col(o)) * (F.col(a) - F.col(o)) for a, o in zip(axes, other, strict=True)), F.lit(0.0))
    if not by:
        near, far = spread(near, *keys), spread(far, *keys)
    return near.join(far.hint("merge"), [*by, *keys]).where(d2 <= radius * radius).withColumn("distance", F.sqrt(d2)).drop(*keys)


def boxes_touching(left: DataFrame, right: DataFrame, cell: float, key: Sequence[str]) -> DataFrame:
    """JN-05: pairs of boxes (x0..y1 and rx0..ry1) that meet.  Both sides are copied to the cells they cover."""
    a = left.withColumn("__i", F.explode(cells_over(F.col("x0"), F.col("x1"), cell))).withColumn("__j", F.explode(cells_over(F.col("y0"), F.col("y1"), cell)))
    b = right.withColumn("__i", F.explode(cells_over(F.col("rx0"), F.col("rx1"), cell))).withColumn("__j", F.explode(cells_over(F.col("ry0"), F.col("ry1"), cell)))
    # a pair that shares many cells counts in the first of them alone
    first = (F.col("__i") == F.greatest(cell_of(F.col("x0"), cell), cell_of(F.col("rx0"), cell))) & (F.col("__j") == F.greatest(cell_of(F.col("y0"), cell), cell_of(F.col("ry0"), cell)))
    meet = (F.col("x0") <= F.col("rx1")) & (F.col("rx0") <= F.col("x1")) & (F.col("y0") <= F.col("ry1")) & (F.col("ry0") <= F.col("y1"))
    at = ("__i", "__j")
    return spread(a, *at).join(spread(b, *at).hint("merge"), list(at)).where(meet & first).drop("__i", "__j")


def points_in_rings(points: DataFrame, rings: DataFrame, cell: float, by: Sequence[str] = ()) -> DataFrame:
    """JN-06: points (x, y) within rings (ring, and its box x0..y1): cell, then box, then crossing number.

    by: columns that must be equal too, as the tile of a footprint (boxes_touching() finds the tiles of each).
    """
    cut = rings.withColumn("__e", geo.edges(F.col("ring")))
    return _in_boxes(points, cut, cell, by).where(geo.inside_edges(F.col("__e"), F.col("x"), F.col("y"))).drop("__e")


def points_in_buffers(points: DataFrame, rings: DataFrame, cell: float, distance: float, by: Sequence[str] = ()) -> DataFrame:
    """JN-06, GE-07: points (x, y) within the mitred buffers of rings (ring, any simple one)."""
    turned = rings.withColumn("ring", geo.counter_clockwise(F.col("ring"))).withColumn("__r", geo.mitre_reach(F.col("ring"), distance))
    box = lambda f, d: f(F.transform("ring", lambda p: p[d]))
    reach = {"x0": box(F.array_min, "x") - F.col("__r"), "y0": box(F.array_min, "y") - F.col("__r"), "x1": box(F.array_max, "x") + F.col("__r"), "y1": box(F.array_max, "y") + F.col("__r")}
    near = _in_boxes(points, turned.withColumns(reach).drop("__r"), cell, by)
    return near.where(geo.within_mitre(F.col("ring"), F.col("x"), F.col("y"), distance))


def points_near_rings(points: DataFrame, rings: DataFrame, cell: float, distance: float, by: Sequence[str] = ()) -> DataFrame:
    """JN-09, GE-20: points (x, y) within or no farther than distance from rings (ring), with that distance."""
    reach = {f"{d}{i}": F.col(f"{d}{i}") + (distance if i else -distance) for d in "xy" for i in (0, 1)}
    near = _in_boxes(points, with_box(rings).withColumns(reach), cell, by)
    return near.withColumn("distance", geo.ring_distance(F.col("ring"), F.col("x"), F.col("y"))).where(F.col("distance") <= distance)


def _in_boxes(points: DataFrame, boxes: DataFrame, cell: float, by: Sequence[str]) -> DataFrame:
    cut = boxes.withColumn("__i", F.explode(cells_over(F.col("x0"), F.col("x1"), cell))).withColumn("__j", F.explode(cells_over(F.col("y0"), F.col("y1"), cell)))
    at = points.withColumns({"__i": cell_of(F.col("x"), cell), "__j": cell_of(F.col("y"), cell)})
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    # boxes grow with the data and by their cells, which no estimate from the source knows: never sent to all tasks
    return at.join(cut.hint("merge"), [*by, "__i", "__j"]).where(inside).drop("__i", "__j")


def edges_of(buildings: DataFrame) -> DataFrame:
    """GE-10: one row an edge of the ring."""
    return buildings.select("id", "ring", geo.centroid(F.col("ring")).alias("__c")).select("id", F.inline(geo.outward_edges(F.col("ring"), centre=F.col("__c"))))


#: What candidate_views() tells of a view.
VIEW = ("id", "edge_idx", "pano_id", "view_type", "distance", "angle", "mx", "my", "px", "py")


def candidate_views(buildings: DataFrame, cameras: DataFrame, radius: float = VIEWS.search_m, edges: DataFrame | None = None, columns: Sequence[str] = VIEW) -> DataFrame:
    """JN-07, GE-12/13, SF-15/16: cameras within radius of an edge's midpoint, on its outer side, outside the building, by view type.

    Edges bring their ring, so pairs are tested where they meet and are not shuffled.  edges: those of ringed_edges() to
    look at, else all.  columns: those of VIEW to tell.
    """
    return sightlines.candidates(ringed_edges(buildings) if edges is None else edges, _cameras(cameras), radius, columns)


def _cameras(cameras: DataFrame) -> DataFrame:
    return cameras.select("pano_id", F.col("x").alias("px"), F.col("y").alias("py")).where("px IS NOT NULL AND py IS NOT NULL")


def ringed_edges(buildings: DataFrame) -> DataFrame:
    """Edges with what tells of the view from a camera.  A file of few MB holds many buildings, and edges take longer than their row."""
    told = spread(buildings.select("id", "ring"), "id").select("id", "ring", geo.centroid(F.col("ring")).alias("__c"))
    return told.select("id", "ring", F.inline(geo.outward_edges(F.col("ring"), centre=F.col("__c")))).select("id", F.col("idx").alias("edge_idx"), "mx", "my", "nx", "ny", "ring")


#: View types of an edge, and cameras that the disc of the first round should hold in five degrees of it.
KINDS, HELD = 5, 1.25


def nearest_views(buildings: DataFrame, cameras: DataFrame, radius: float = VIEWS.search_m) -> DataFrame:
    """WN-05: id, edge_idx, view_type, pano_id: the nearest camera of each edge and view type, ties to the smaller pano_id.

    Discs double up to radius; an edge with a camera of every type is done, as none farther off is nearer.  The first
    disc follows from how densely cameras lie, so that an edge meets about as many of them however many there are.
    """
    box = cameras.agg(F.count("*").alias("n"), *(f(a).alias(a + s) for a in "xy" for f, s in ((F.min, "0"), (F.max, "1")))).first()
    area = (box["x1"] - box["x0"]) * (box["y1"] - box["y0"]) if box["n"] else 0.0
    reach = min(radius, (HELD * 72 * area / (math.pi * box["n"])) ** 0.5) if area else radius
    open_, done = durable(ringed_edges(buildings), "edges"), None
    while True:
        found = durable(sightlines.nearest(open_, _cameras(cameras), reach).select("id", "edge_idx", "view_type", "pano_id"), "views")
        if reach >= radius:
            return found if done is None else done.unionByName(found)
        full = durable(found.groupBy("id", "edge_idx").agg(F.count("*").alias("n")).where(F.col("n") == KINDS).select("id", "edge_idx"), "full")
        settled = found.join(full, ["id", "edge_idx"], "left_semi")
        done = settled if done is None else done.unionByName(settled)
        open_ = open_.join(full, ["id", "edge_idx"], "left_anti")
        reach = min(radius, 2 * reach)


def chosen(candidates: DataFrame) -> DataFrame:
    """WN-05: the nearest camera of each edge and view type."""
    w = Window.partitionBy("id", "edge_idx", "view_type").orderBy("distance", "pano_id")
    return candidates.withColumn("is_chosen", F.row_number().over(w) == 1)


def _of(d: str):
    return lambda p: p[d]


def with_box(rings: DataFrame, ring: str = "ring", prefix: str = "") -> DataFrame:
    """rings with x0, y0, x1, y1, the box of each ring."""
    ends = {f"{prefix}{d}{i}": f(F.transform(ring, _of(d))) for d in "xy" for i, f in ((0, F.array_min), (1, F.array_max))}
    return rings.withColumns(ends)


def rings_meeting(left: DataFrame, right: DataFrame, cell: float, key: str, other: str, exact: bool = True) -> DataFrame:
    """JN-05, GE-05: pairs (key, ring) and (other, other_ring) of any simple rings that meet, by border or inside; boxes meet first.

    exact=False: pairs whose boxes meet, for callers that ask for a shared area after.
    """
    a = with_box(left.select(key, "ring"))
    b = with_box(right.select(F.col(key).alias(other), F.col("ring").alias("other_ring")), "other_ring", "r")
    near = boxes_touching(a, b, cell, [key])
    near = near.where(geo.intersects(F.col("ring"), F.col("other_ring"))) if exact else near
    return near.select(key, other, "ring", "other_ring")


def overlapping(buildings: DataFrame, cell: float, least: float = VIEWS.overlap_area) -> DataFrame:
    """GE-14: id, bid: buildings whose rings share more than least, each pair both ways.  Boxes meet first."""
    kept = durable(shared_areas(buildings, "id", "bid", cell).where(F.col("area") > least).select("id", "bid"), "overlaps")
    return kept.unionByName(kept.select(F.col("bid").alias("id"), F.col("id").alias("bid")))


def visible(rays: DataFrame, blockers: DataFrame, cell: float, keys: Sequence[str], overlaps: DataFrame | None = None, slack: float = VIEWS.occlusion_slack) -> DataFrame:
    """JN-08: the rays (keys, id, px..my) from P to M that no other building's edge crosses more than slack before M.

    Blockers (bid, ax..by) lie in the cells their boxes cover, rays in those theirs cover.  Only pairs that hit go on:
    those of buildings that overlap the ray's own (id, bid of overlaps) are taken out, and rays with a hit left are dropped.
    """
    rays = durable(rays, "rays")
    lo, hi = (lambda a, b: F.least(F.col(a), F.col(b))), (lambda a, b: F.greatest(F.col(a), F.col(b)))
    r = rays.select(*dict.fromkeys([*keys, "id", "px", "py", "mx", "my"]))
    r = r.withColumn("__i", F.explode(cells_over(lo("px", "mx"), hi("px", "mx"), cell))).withColumn("__j", F.explode(cells_over(lo("py", "my"), hi("py", "my"), cell)))
    b = blockers.withColumn("__i", F.explode(cells_over(lo("ax", "bx"), hi("ax", "bx"), cell))).withColumn("__j", F.explode(cells_over(lo("ay", "by"), hi("ay", "by"), cell)))
    hit = geo.segment_hit(*(F.col(c) for c in ("px", "py", "mx", "my", "ax", "ay", "bx", "by")))
    length = F.hypot(F.col("mx") - F.col("px"), F.col("my") - F.col("py"))
    hits = r.join(b.hint("merge"), ["__i", "__j"]).where((F.col("id") != F.col("bid")) & (hit * length + slack < length)).select(*dict.fromkeys([*keys, "id", "bid"]))
    if overlaps is not None:
        hits = hits.join(overlaps, ["id", "bid"], "left_anti")
    return rays.join(hits.select(*keys).distinct(), list(keys), "left_anti")


def visible_views(buildings: DataFrame, cameras: DataFrame, cell: float = 40.0, radius: float = VIEWS.search_m) -> DataFrame:
    """JN-08: id, edge_idx, pano_id: candidate_views() that visible() keeps, with the walls of all buildings but those that overlap the view's own."""
    edges = durable(ringed_edges(buildings), "edges")
    beside = overlapping(buildings, cell).groupBy("id").agg(F.collect_list("bid").alias("beside"))
    walls = edges_of(spread(buildings.select("id", "ring"), "id")).select(F.col("id").alias("bid"), "ax", "ay", "bx", "by")
    return sightlines.unblocked(edges.join(beside.hint("merge"), "id", "left"), _cameras(cameras), walls, radius)


def vertex_pixels(views: DataFrame, rings: DataFrame, width: int, short: float = 0.999) -> DataFrame:
    """GE-15, SF-12: views (id, cam_x, cam_y, yaw, ...) with px, the column of each corner of the ring that they see.

    A corner is seen if the ray to it, cut just before it, meets no edge of the ring.
    """
    at = views.join(rings.select("id", "ring"), "id").withColumn("__v", F.explode("ring"))
    dx, dy = F.col("__v.x") - F.col("cam_x"), F.col("__v.y") - F.col("cam_y")
    to_x, to_y = F.col("cam_x") + short * dx, F.col("cam_y") + short * dy
    meets = lambda e: geo.segment_hit(F.col("cam_x"), F.col("cam_y"), to_x, to_y, e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]).isNotNull()
    seen = at.where(~F.exists(geo.edges(F.col("ring")), meets))
    bearing = F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))
    return seen.withColumn("px", geo.bearing_pixel(bearing, F.col("yaw"), width)).drop("__v", "ring", "cam_x", "cam_y", "yaw")


def clip_bounds(pixels: DataFrame, keys: Sequence[str], width: int, height: int, upper: float, lower: float, margin: float = 0.05, least: int = 20) -> DataFrame:
    """GE-16/17: columns from the least to the greatest visible pixel with a margin, and the rows kept; empty windows are left out."""
    span = pixels.groupBy(*keys).agg(F.min("px").alias("lo"), F.max("px").alias("hi"))
    buffer = F.greatest(F.lit(least), F.floor((F.col("hi") - F.col("lo")) * margin).cast("int"))
    out = span.withColumns({"clip_left": F.greatest(F.lit(0), F.col("lo") - buffer), "clip_right": F.least(F.lit(width), F.col("hi") + buffer), "clip_top": F.bround(F.lit(upper * height), 0).cast("int"), "clip_bottom": F.bround(F.lit(lower * height), 0).cast("int")})
    return out.where("clip_right > clip_left AND clip_bottom > clip_top").select(*keys, "clip_left", "clip_right", "clip_top", "clip_bottom")
