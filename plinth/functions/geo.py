"""Plane and spherical geometry as Column expressions.  A ring is array<struct<x,y>>, closed or not."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from ..config import VIEWS


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """SF-11: radians in [0, 2 pi), from the first point to the second, clockwise from north."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    angle = F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))
    return F.when(angle < 0, angle + 2 * math.pi).otherwise(angle)


def bearing_pixel(bearing_deg: Column, yaw: Column, width: Column | int) -> Column:
    """SF-12: column of a panorama that looks along bearing, half-even rounded and clamped."""
    width = F.lit(width) if isinstance(width, int) else width
    delta = F.pmod(F.pmod(bearing_deg - yaw + 180.0, F.lit(360.0)) + 360.0, F.lit(360.0)) - 180.0
    px = F.pmod(delta / 360.0 * width + width / 2, width.cast("double"))
    return F.least(F.greatest(F.bround(px, 0).cast("int"), F.lit(0)), width.cast("int") - 1)


def localise(lat: Column, lon: Column, yaw: Column, to_lat: Column, to_lon: Column, width: int, extend: float = 90.0) -> Column:
    """SF-13: bearing, centre column and the columns extend / 2 degrees to both sides."""
    b = F.degrees(bearing(lat, lon, to_lat, to_lon))
    return F.struct(b.alias("bearing"), bearing_pixel(b, yaw, width).alias("centre"), bearing_pixel(b - extend / 2, yaw, width).alias("left"), bearing_pixel(b + extend / 2, yaw, width).alias("right"))


def camera_heading(heading: Column) -> Column:
    """SF-14."""
    return F.pmod(-heading, F.lit(360.0))


def signed_angle(nx: Column, ny: Column, vx: Column, vy: Column) -> Column:
    """SF-15: degrees from the normal to the vector."""
    return F.degrees(F.atan2(nx * vy - ny * vx, nx * vx + ny * vy))


def view_type(angle: Column) -> Column:
    """SF-16: null between the classes."""
    e, (s0, s1), (o0, o1) = VIEWS.eps, VIEWS.semi, VIEWS.oblique
    inside = lambda lo, hi: (angle >= lo - e) & (angle <= hi + e)
    return (
        F.when(F.abs(angle) <= VIEWS.direct + e, "direct")
        .when(inside(s0, s1), "semi_oblique_left")
        .when(inside(-s1, -s0), "semi_oblique_right")
        .when(inside(o0, o1), "oblique_left")
        .when(inside(-o1, -o0), "oblique_right")
    )


def edges(ring: Column) -> Column:
    """Pairs (point, next point) of a ring; the last meets the first."""
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(pairs: Column, term) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda s, e: s + term(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]))


def signed_area(ring: Column) -> Column:
    """Shoelace; positive when counter-clockwise."""
    return _sum(edges(ring), lambda ax, ay, bx, by: (ax * by - bx * ay) / 2)


def area(ring: Column) -> Column:
    """GE-18."""
    return F.abs(signed_area(ring))


def perimeter(ring: Column) -> Column:
    return _sum(edges(ring), lambda ax, ay, bx, by: F.hypot(bx - ax, by - ay))


def centroid(ring: Column) -> Column:
    """GE-02: null components for a ring without area."""
    pairs, twice = edges(ring), signed_area(ring) * 6
    x = _sum(pairs, lambda ax, ay, bx, by: (ax + bx) * (ax * by - bx * ay))
    y = _sum(pairs, lambda ax, ay, bx, by: (ay + by) * (ax * by - bx * ay))
    return F.struct(F.try_divide(x, twice).alias("x"), F.try_divide(y, twice).alias("y"))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """GE-19: crossing number, half-open in y, so that a shared border belongs to one side."""
    return inside_edges(edges(ring), x, y)


def inside_edges(edges_: Column, x: Column, y: Column) -> Column:
    """contains() for edges() made once a ring."""

    def crosses(e: Column) -> Column:
        ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        at = (bx - ax) * F.try_divide(y - ay, by - ay) + ax
        return F.when((ay > y) != (by > y), F.when(x < at, 1).otherwise(0)).otherwise(0)

    return F.aggregate(edges_, F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1


def ring_distance(ring: Column, x: Column, y: Column) -> Column:
    """GE-12, GE-20: 0 within the ring, else the distance to its nearest edge; a ring may be one point or one line."""

    def to(e: Column) -> Column:
        ax, ay, dx, dy = e["a"]["x"], e["a"]["y"], e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        t = F.least(F.greatest(F.coalesce(F.try_divide((x - ax) * dx + (y - ay) * dy, dx * dx + dy * dy), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
        u, v = x - (ax + t * dx), y - (ay + t * dy)
        return F.sqrt(u * u + v * v)

    return F.when(contains(ring, x, y), F.lit(0.0)).otherwise(F.array_min(F.transform(edges(ring), to)))


def within_mitre(ring: Column, x: Column, y: Column, distance: float, limit: float = 5.0) -> Column:
    """GE-07: whether a point lies in the ring's buffer with mitred corners, for any simple counter-clockwise ring.

    The buffer is the union of the ring, of a rectangle on the outer side of each edge and of a kite at each corner
    that turns left; a kite whose tip would be further than limit distances off is cut there, square to its axis.
    """
    sides = F.zip_with(edges(ring), F.concat(F.slice(ring, 3, F.size(ring)), F.slice(ring, 1, 2)), lambda e, c: F.struct(e["a"].alias("a"), e["b"].alias("b"), c.alias("c")))

    def unit(p: Column, q: Column) -> tuple[Column, Column, Column]:
        length = F.hypot(q["x"] - p["x"], q["y"] - p["y"])
        return F.try_divide(q["x"] - p["x"], length), F.try_divide(q["y"] - p["y"], length), length

    def near(s: Column) -> Column:
        ux, uy, length = unit(s["a"], s["b"])
        vx, vy, _ = unit(s["b"], s["c"])
        along, off = (x - s["a"]["x"]) * ux + (y - s["a"]["y"]) * uy, (x - s["a"]["x"]) * uy - (y - s["a"]["y"]) * ux
        beside = (along >= 0) & (along <= length) & (off >= 0) & (off <= distance)
        # at the corner b: outer distances to both lines, past the end of one and before the start of the next
        dx, dy = x - s["b"]["x"], y - s["b"]["y"]
        o1, o2, t1, t2 = dx * uy - dy * ux, dx * vy - dy * vx, dx * ux + dy * uy, dx * vx + dy * vy
        cosine = ux * vx + uy * vy
        half = F.sqrt(F.greatest((1 + cosine) / 2, F.lit(0.0)))  # of half the turn: the tip lies distance / half off
        axis = F.try_divide(o1 + o2, 2 * half)
        corner = (ux * vy - uy * vx > 0) & (t1 >= 0) & (t2 <= 0) & (o1 <= distance) & (o2 <= distance) & (axis <= limit * distance)
        return F.coalesce(beside | corner, F.lit(False))

    return contains(ring, x, y) | F.exists(sides, near)


def mitre_reach(ring: Column, distance: float, limit: float = 5.0) -> Column:
    """How far the tips of within_mitre() lie from their corners at most."""
    turns = F.zip_with(edges(ring), F.concat(F.slice(ring, 3, F.size(ring)), F.slice(ring, 1, 2)), lambda e, c: _tip(e["a"], e["b"], c))
    return distance * F.least(F.greatest(F.coalesce(F.array_max(turns), F.lit(limit)), F.lit(1.0)), F.lit(limit))


def _tip(a: Column, b: Column, c: Column) -> Column:
    ux, uy, vx, vy = b["x"] - a["x"], b["y"] - a["y"], c["x"] - b["x"], c["y"] - b["y"]
    cosine = F.try_divide(ux * vx + uy * vy, F.hypot(ux, uy) * F.hypot(vx, vy))
    return F.try_divide(F.lit(1.0), F.sqrt(F.greatest((1 + cosine) / 2, F.lit(0.0))))


def counter_clockwise(ring: Column) -> Column:
    return F.when(signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """GE-01: counter-clockwise corners."""
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1))


def wkt(ring: Column) -> Column:
    """GE-18: POLYGON text, closed."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    points = F.transform(closed, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(points, ", "), F.lit("))"))


def ring_of(text: Column) -> Column:
    """GE-18: the outer ring of POLYGON text, without the closing point."""
    body = F.regexp_extract(text, r"\(\(([^)]*)\)", 1)
    points = F.transform(F.split(body, r"\s*,\s*"), lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].try_cast("double").alias("x"), F.split(F.trim(p), r"\s+")[1].try_cast("double").alias("y")))
    return F.when((F.size(points) > 1) & (points[0] == F.element_at(points, -1)), F.slice(points, F.lit(1), F.size(points) - 1)).otherwise(points)


def outward_edges(ring: Column, min_length: float = 1e-6, centre: Column | None = None) -> Column:
    """GE-10: of each edge that is long enough: idx (from 0, among those kept), ends, midpoint, outward normal, length.

    centre: the ring's centroid(), if it is a column already; else it is told again for each edge.
    """
    c = centroid(ring) if centre is None else centre

    def described(e: Column) -> Column:
        ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        length = F.hypot(bx - ax, by - ay)
        mx, my, nx, ny = (ax + bx) / 2, (ay + by) / 2, F.try_divide(by - ay, length), F.try_divide(ax - bx, length)
        sign = F.when(nx * (c["x"] - mx) + ny * (c["y"] - my) > 0, -1.0).otherwise(1.0)
        return F.struct(ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"), mx.alias("mx"), my.alias("my"), (nx * sign).alias("nx"), (ny * sign).alias("ny"), length.alias("length"))

    kept = F.filter(F.transform(edges(ring), described), lambda e: e["length"] >= min_length)
    return F.transform(kept, lambda e, i: F.struct(i.alias("idx"), *(e[f].alias(f) for f in ("ax", "ay", "bx", "by", "mx", "my", "nx", "ny", "length"))))


def sector(mx: Column, my: Column, nx: Column, ny: Column, from_deg: float, to_deg: float, radius: float = VIEWS.search_m, steps: int = 16) -> Column:
    """GE-11: midpoint and points of an arc around the rotated normal."""
    arc = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.radians(F.lit(float(from_deg)) + i * F.lit((to_deg - from_deg) / (steps - 1))))
    points = F.transform(arc, lambda t: F.struct((mx + radius * (nx * F.cos(t) - ny * F.sin(t))).alias("x"), (my + radius * (nx * F.sin(t) + ny * F.cos(t))).alias("y")))
    return F.concat(F.array(F.struct(mx.alias("x"), my.alias("y"))), points)


def segment_hit(px: Column, py: Column, qx: Column, qy: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """GE-14: where along PQ (0 to 1) it meets segment AB; null if it does not."""
    rx, ry, sx, sy = qx - px, qy - py, bx - ax, by - ay
    cross = rx * sy - ry * sx
    t = F.try_divide((ax - px) * sy - (ay - py) * sx, cross)
    u = F.try_divide((ax - px) * ry - (ay - py) * rx, cross)
    return F.when((t >= 0) & (t <= 1) & (u >= 0) & (u <= 1), t)


def intersects(ring: Column, other: Column) -> Column:
    """GE-05: whether two simple rings meet: their borders touch or cross, or one lies inside the other."""
    first = lambda r, d: F.element_at(r, 1)[d]

    def meets(e: Column):
        return lambda o: segment_hit(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"], o["a"]["x"], o["a"]["y"], o["b"]["x"], o["b"]["y"]).isNotNull()

    borders = F.exists(edges(ring), lambda e: F.exists(edges(other), meets(e)))
    return borders | contains(ring, first(other, "x"), first(other, "y")) | contains(other, first(ring, "x"), first(ring, "y"))


def measurement(x1: Column, y1: Column, z1: Column, x2: Column, y2: Column, z2: Column) -> Column:
    """SF-30: height difference, horizontal and slope distance, angle in degrees."""
    flat, rise = F.hypot(x2 - x1, y2 - y1), z2 - z1
    return F.struct(F.round(rise, 3).alias("rise"), F.round(flat, 3).alias("flat"), F.round(F.hypot(flat, rise), 3).alias("slope"), F.round(F.degrees(F.atan2(rise, flat)), 1).alias("angle"))


def rotation(yaw: Column, pitch: Column, roll: Column) -> list[list[Column]]:
    """SF-25: Rz(yaw) Ry(pitch) Rx(roll), degrees, as nine Columns."""
    cy, sy, cp, sp, cr, sr = (f(F.radians(a)) for a in (yaw, pitch, roll) for f in (F.cos, F.sin))
    return [
        [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr],
        [sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr],
        [-sp, cp * sr, cp * cr],
    ]


# GRS80 and the transverse Mercator grid of zone 55/56.
_A, _F, _K0, _FE, _FN = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, 10000000.0
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)


def to_grid(lon: Column, lat: Column, zone: int) -> Column:
    """GE-06: easting and northing by the Krueger series (southern hemisphere)."""
    e = math.sqrt(_F * (2 - _F))
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    x, y = eta, xi
    for k, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        y = y + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return F.struct((_FE + _K0 * _R * x).alias("x"), (_FN + _K0 * _R * y).alias("y"))
