"""Point cloud statistics and projections.  A cloud is one row a point; key names the clip or tile."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..config import LAS_CLASSES, RASTER
from ..tables import durable
from .quantiles import aggregated

BANDS = ((0, 3), (3, 6), (6, 9), (9, 12), (12, 15), (15, 20), (20, 30), (30, 50))


def basic_stats(points: DataFrame, key: str) -> DataFrame:
    """PC-03/06/07."""
    plain = [
        F.count("*").alias("point_count"),
        F.min("z").alias("z_min"),
        F.max("z").alias("z_max"),
        (F.max("z") - F.min("z")).alias("z_range"),
        F.avg("z").alias("z_mean"),
        F.stddev_pop("z").alias("z_std"),
        F.count_if(F.col("number_of_returns") == 1).alias("returns_single"),
        F.count_if(F.col("number_of_returns") != 1).alias("returns_multiple"),
        F.avg("intensity").alias("intensity_mean"),
        F.stddev_pop("intensity").alias("intensity_std"),
    ]
    return aggregated(points, [key], plain, {f"z_p{p}": ("z", p / 100, None) for p in (10, 25, 50, 75, 90)})


def _relative(points: DataFrame, key: str, where: Column | None = None, name: str = "z_rel") -> DataFrame:
    """Height above the lowest point of the group (of those that where selects).  A grouped minimum and a join back: no group is gathered."""
    low = (points if where is None else points.where(where)).groupBy(key).agg(F.min("z").alias("__low"))
    return points.join(low, key, "left").withColumn(name, F.col("z") - F.col("__low")).drop("__low")


def height_bands(points: DataFrame, key: str) -> DataFrame:
    """PC-04/12/14."""
    building = F.col("classification") == 6
    rel = _relative(_relative(points, key), key, building, "b_rel")
    inside = lambda c, a, b: (F.col(c) >= a) & (F.col(c) < b)
    ratio = lambda a, b: F.coalesce(F.try_divide(F.count_if(inside("z_rel", a, b) & (F.col("number_of_returns") > 1)), F.count_if(inside("z_rel", a, b))), F.lit(0.0))
    many = F.count_if(building) > 10
    return rel.groupBy(key).agg(
        *(F.count_if(inside("z_rel", a, b)).alias(f"pts_{a}_{b}m") for a, b in BANDS[:4]),
        F.count_if(F.col("z_rel") >= 12).alias("pts_above_12m"),
        *(F.when(many, F.count_if(building & inside("b_rel", a, b)) / float(b - a)).otherwise(0.0).alias(f"building_density_{a}_{b}m") for a, b in BANDS),
        *(ratio(a, b).alias(f"multi_return_ratio_{a}_{b}m") for a, b in ((0, 10), (10, 20), (20, 30), (30, 50))),
    )


def class_stats(points: DataFrame, key: str) -> DataFrame:
    """PC-08/09/15, AG-19."""
    of = lambda c: F.col("classification") == c
    n = lambda c: F.count_if(of(c))
    var = lambda c: F.when(n(c) > 3, F.var_pop(F.when(of(c), F.col("z")))).otherwise(0.0)
    plain = [
        *(n(i).alias(f"class_{i}_{name}") for i, name in enumerate(LAS_CLASSES)),
        F.coalesce(F.avg(F.when(of(2), F.col("z"))), F.lit(0.0)).alias("ground_z_mean"),
        F.coalesce(F.stddev_pop(F.when(of(2), F.col("z"))), F.lit(0.0)).alias("ground_z_std"),
        (n(3) + n(4) + n(5)).alias("vegetation_proximity_count"),
        var(6).alias("roof_z_variance"),
        var(2).alias("ground_height_variance"),
        var(6).alias("building_height_variance"),
    ]
    quartiles = {f"__q{c}_{p}": ("z", p / 100, f"classification = {c}") for c in (2, 6) for p in (25, 75)}
    told = aggregated(points, [key], plain, quartiles)
    count = {c: F.col(f"class_{c}_{LAS_CLASSES[c]}") for c in (2, 6)}
    iqr = {f"{name}_height_iqr": F.when(count[c] > 3, F.col(f"__q{c}_75") - F.col(f"__q{c}_25")).otherwise(0.0) for c, name in ((2, "ground"), (6, "building"))}
    return told.withColumns(iqr).drop(*quartiles)


def shape_scores(points: DataFrame, key: str) -> DataFrame:
    """PC-10/13: verticality, planarity, and the facade score (0.8 where a 3 m slab of edge points is dense)."""
    building = points.where("classification = 6")
    limits = aggregated(building, [key], [F.count("*").alias("nb"), F.min("z").alias("bz"), F.max("z").alias("tz")], {f"{c}{p}": (c, p / 100, None) for c in "xy" for p in (10, 90)})
    outer = (F.col("x") < F.col("x10")) | (F.col("x") > F.col("x90")) | (F.col("y") < F.col("y10")) | (F.col("y") > F.col("y90"))
    edge = building.join(limits.where("nb > 100"), key).where(outer).withColumn("slab", F.floor((F.col("z") - F.col("bz")) / 3.0))
    slabs = edge.groupBy(key, "slab").agg(F.count("*").alias("n"), F.first("bz").alias("bz"), F.first("tz").alias("tz"))
    within = F.col("slab") * 3 < F.floor(F.col("tz") - F.col("bz"))
    facade = slabs.groupBy(key).agg(F.sum("n").alias("edge_points"), F.max(F.when(within, F.col("n"))).alias("most"))
    facade = facade.select(key, F.when((F.col("edge_points") > 20) & (F.col("most") > 10), 0.8).otherwise(0.0).alias("facade"))
    extent = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    rise = F.max("z") - F.min("z")
    many = F.count("*") > 10
    base = points.groupBy(key).agg(
        F.when(many, F.least(F.coalesce(F.try_divide(rise, extent), F.lit(0.0)), F.lit(10.0))).otherwise(0.0).alias("verticality_score"),
        F.when(many, 1.0 / (1.0 + F.stddev_pop("z"))).otherwise(0.0).alias("planarity_score"),
    )
    return base.join(facade, key, "left").withColumn("facade_alignment_score", F.coalesce("facade", F.lit(0.0))).drop("facade")


def height_peaks(points: DataFrame, key: str, bin_m: float = 0.5, least: int = 10) -> DataFrame:
    """WN-10, PC-11: strict local maxima of the histogram of building heights, and the deviation of their spacing.

    Bins run from 0 to the last whole one; the histogram's last bin is closed.  Groups need more than 10 points
    and more than two bins.
    """
    building = points.where("classification = 6")
    rel = _relative(building, key)
    span = rel.groupBy(key).agg(F.count("*").alias("nb"), F.max("z_rel").alias("top")).where(F.col("nb") > 10)
    # edges 0, b, 2b ... below top + b; one bin fewer than edges
    span = span.withColumn("bins", (F.ceil((F.col("top") + bin_m) / bin_m) - 1).cast("int")).where("bins > 2")
    at = rel.join(span.select(key, "bins"), key).where(F.col("z_rel") <= F.col("bins") * bin_m)
    counts = at.groupBy(key, F.least(F.floor(F.col("z_rel") / bin_m).cast("int"), F.col("bins") - 1).alias("bin")).agg(F.count("*").alias("n"))
    grid = span.select(key, F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin")).join(counts, [key, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    w = Window.partitionBy(key).orderBy("bin")
    peak = (F.col("n") > F.lag("n").over(w)) & (F.col("n") > F.lead("n").over(w)) & (F.col("n") > least)
    peaks = grid.withColumn("peak", peak).where("peak").withColumn("gap", (F.col("bin") - F.lag("bin").over(w)) * bin_m)
    found = peaks.groupBy(key).agg(F.count("*").alias("n"), F.coalesce(F.stddev_pop("gap"), F.lit(0.0)).alias("spread"))
    return span.select(key).join(found, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("building_height_peaks"), F.coalesce("spread", F.lit(0.0)).alias("building_height_regularity"))


def ground_elevation(points: DataFrame, key: str) -> DataFrame:
    """AG-16, SF-27 over the ground class."""
    plain = [
        F.avg("z").alias("ground_elevation_m"),
        F.min("z").alias("min_z"),
        F.max("z").alias("max_z"),
        F.stddev_pop("z").alias("std"),
        F.count("*").alias("ground_points_count"),
        F.least(F.lit(1.0), F.count("*") / 100.0).alias("confidence_score"),
    ]
    return aggregated(points.where("classification = 2"), [key], plain, {"median": ("z", 0.5, None), "p25": ("z", 0.25, None), "p75": ("z", 0.75, None)})


def in_grid(points: DataFrame, box: DataFrame, key: str, cell: float) -> DataFrame:
    """points with cell i, j of nx by ny: equal bins over the range in box (key, x0, x1, y0, y1, more), the last one closed."""
    bins = lambda a, b: F.greatest(F.lit(1), F.ceil((F.col(b) - F.col(a)) / cell).cast("int"))
    box = box.withColumns({"nx": bins("x0", "x1"), "ny": bins("y0", "y1")})
    at = lambda v, lo, hi, n: F.least(F.floor(F.coalesce(F.try_divide((F.col(v) - F.col(lo)) * F.col(n), F.col(hi) - F.col(lo)), F.lit(0.0))).cast("int"), F.col(n) - 1)
    return points.join(box, key).withColumns({"i": at("x", "x0", "x1", "nx"), "j": at("y", "y0", "y1", "ny")})


def cell_statistics(cell: float) -> list[Column]:
    """AG-20/21 over filled cells (n, nx, ny): mean and variation of their density, share of empty ones.

    The variation comes from whole numbers: sqrt(cells * sum of squares - square of the sum) / sum.  So a tile that lies
    on a threshold lies on it whatever the order of its cells.
    """
    cells = F.first(F.col("nx") * F.col("ny"))
    area = cell * cell
    whole = lambda c: c.cast("decimal(19,0)")
    spread = whole(F.count("*")) * whole(F.sum(F.col("n") * F.col("n"))) - whole(F.sum("n")) * whole(F.sum("n"))
    variation = F.try_divide(F.sqrt(spread.cast("double")), F.sum("n"))
    return [(F.avg("n") / area).alias("mean_density"), variation.alias("variation"), F.count("*").alias("filled"), cells.alias("cells"), (1.0 - F.count("*") / cells).alias("void_ratio")]


def density_grid(points: DataFrame, key: str, cell: float) -> DataFrame:
    """AG-20/21: ceil(range / cell) equal bins over the range of x and of y."""
    box = points.groupBy(key).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    cells = in_grid(points, box, key, cell).groupBy(key, "i", "j", "nx", "ny").agg(F.count("*").alias("n"))
    return cells.groupBy(key).agg(*cell_statistics(cell))


#: Products of deviations that a plane is fitted by.
PLANE_SUMS = ("xx", "xy", "yy", "xz", "yz", "zz")


def fitted_plane(s: DataFrame) -> DataFrame:
    """a, b and residual_std of the least-squares plane, from n and the centred sums sxx to szz; null where the points lie on a line."""
    det = F.col("sxx") * F.col("syy") - F.col("sxy") * F.col("sxy")
    s = s.withColumns({"a": F.try_divide(F.col("sxz") * F.col("syy") - F.col("syz") * F.col("sxy"), det), "b": F.try_divide(F.col("syz") * F.col("sxx") - F.col("sxz") * F.col("sxy"), det)})
    rest = F.greatest(F.lit(0.0), (F.col("szz") - F.col("a") * F.col("sxz") - F.col("b") * F.col("syz")) / F.col("n"))
    return s.withColumn("residual_std", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.sqrt(rest)))


def plane_residual(points: DataFrame, key: str) -> DataFrame:
    """QA-03: deviation from the least-squares plane, from centred sums; null where the points lie on a line."""
    mean = points.groupBy(key).agg(*(F.avg(a).alias(f"m{a}") for a in "xyz"))
    c = points.join(mean, key).withColumns({f"d{a}": F.col(a) - F.col(f"m{a}") for a in "xyz"})
    s = c.groupBy(key).agg(F.count("*").alias("n"), *(F.sum(F.col(f"d{a}") * F.col(f"d{b}")).alias(f"s{a}{b}") for a, b in PLANE_SUMS))
    return fitted_plane(s).select(key, "a", "b", "residual_std")


def stepped(rows: DataFrame, key: str, value: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """WN-09: key, value, keep, __n, step: rows in order of (key, value, order), numbered, with value less that of the row before.

    Rows are dealt by ranges of that order, so a key of any size is spread.  Within a range the row before is at hand;
    the last row of each range, one a partition, is carried to the next one.  The first row of a key has no step.
    """
    names = [key, value, *keep]
    dealt = rows.select(*names, *(c for c in order if c not in names)).repartitionByRange(key, value, *order).sortWithinPartitions(key, value, *order)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = (batch.column(i) for i in (0, 1))
            before = [pa.concat_arrays([pa.array([last[i] if last else None], c.type), c.slice(0, len(c) - 1)]) for i, c in enumerate((keys, values))]
            step = pc.if_else(pc.fill_null(pc.equal(keys, before[0]), False), pc.subtract(values, before[1]), pa.scalar(None, values.type))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(at, at + len(keys))), step], names=[*batch.schema.names, "__i", "step"])
            at, last = at + len(keys), (keys[-1].as_py(), values[-1].as_py())

    cut = dealt.select(*names, F.spark_partition_id().alias("__part"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    told = durable(cut.mapInArrow(numbered, f"{kinds}, __i bigint, step {cut.schema[value].dataType.simpleString()}"), "steps")
    parts = told.groupBy("__part").agg(F.count("*").alias("n"), F.max_by(F.struct(F.col(key).alias("key"), F.col(value).alias("value")), "__i").alias("last"))
    w = Window.orderBy("__part")  # a row a partition
    carried = parts.select("__part", (F.sum("n").over(w) - F.col("n")).alias("__base"), F.lag("last").over(w).alias("__last"))
    first = F.when((F.col("__i") == 0) & (F.col("__last.key") == F.col(key)), F.col(value) - F.col("__last.value"))
    return told.join(F.broadcast(carried), "__part").select(*names, (F.col("__base") + F.col("__i")).alias("__n"), F.coalesce("step", first).alias("step"))


def gps_gaps(points: DataFrame, key: str, order: Sequence[str], factor: float = 10.0, around: int = 100) -> DataFrame:
    """WN-09: gaps of more than factor times the 95th percentile of time steps, with the median height before and after.

    Gaps are found by number and time step alone; only the points around them are fetched by their numbers.
    """
    rows = stepped(points, key, "gps_time", order, ["z"])
    limit = aggregated(rows, [key], [], {"limit": ("step", 0.95, None)}).withColumn("limit", F.col("limit") * factor)
    gaps = rows.join(limit, key).where("step > limit").select(key, "gps_time", "step", F.col("__n").alias("__gap"))
    near = gaps.withColumn("__n", F.explode(F.sequence(F.col("__gap") - around, F.col("__gap") + around - 1)))
    near = near.join(rows.select(key, "__n", "z"), [key, "__n"])
    before = F.col("__n") < F.col("__gap")
    median = lambda side: F.percentile(F.when(side, F.col("z")), F.lit(0.5))
    return near.groupBy(key, "__gap", "gps_time", "step").agg((median(~before) - median(before)).alias("jump")).drop("__gap")


def equirectangular(points: DataFrame, camera: Sequence[float], width: int, height: int) -> DataFrame:
    """SF-26: pixel and range of each point around a camera at (x, y, z): u grows to the right, v downwards."""
    dx, dy, dz = F.col("x") - camera[0], F.col("y") - camera[1], F.col("z") - camera[2]
    r = F.sqrt(dx * dx + dy * dy + dz * dz)
    theta, phi = F.atan2(dx, dy), F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.try_divide(dz, r))))
    pi = F.pi()
    u = F.least(F.greatest(F.floor((theta / pi + 1) / 2 * (width - 1)).cast("int"), F.lit(0)), F.lit(width - 1))
    v = F.least(F.greatest(F.floor(phi / pi * (height - 1)).cast("int"), F.lit(0)), F.lit(height - 1))
    return points.withColumn("r", r).where((F.col("r") > 0) & (F.col("r") < RASTER.nodata)).withColumns({"u": u, "v": v})


def zbuffer(projected: DataFrame, keys: Sequence[str], keep: Sequence[str], mode: str = "nearest") -> DataFrame:
    """PC-17, WN-12: one row a pixel: the nearest point, or the farthest.  A grouped minimum, combined map-side."""
    row = F.struct("r", *keep)
    pick = F.min(row) if mode == "nearest" else F.max(row)
    return projected.groupBy(*keys, "u", "v").agg(pick.alias("p")).select(*keys, "u", "v", "p.*")


def class_aware(projected: DataFrame, keys: Sequence[str], keep: Sequence[str], classes: Sequence[int] = (2, 6)) -> DataFrame:
    """PC-18: pixels of ground and building by their nearest point; other pixels from the plain raster unless it shows those classes."""
    own = zbuffer(projected.where(F.col("classification").isin(*classes)), keys, keep)
    rest = zbuffer(projected, keys, keep, "farthest").where(~F.col("classification").isin(*classes))
    return own.unionByName(rest.join(own.select(*keys, "u", "v"), [*keys, "u", "v"], "left_anti"))


def perspective(points: DataFrame, camera: Sequence[float], width: int, height: int, fov_deg: float) -> DataFrame:
    """PC-19: a pinhole camera that looks along y; v is flipped; points behind or outside the frame are left out."""
    import math

    f = width / 2 / math.tan(math.radians(fov_deg) / 2)
    dx, dy, dz = F.col("x") - camera[0], F.col("y") - camera[1], F.col("z") - camera[2]
    ahead = points.withColumns({"r": F.sqrt(dx * dx + dy * dy + dz * dz), "__d": dy}).where("__d > 0")
    out = ahead.withColumns({"u": F.floor(f * dx / F.col("__d") + width / 2).cast("int"), "v": (height - 1 - F.floor(f * dz / F.col("__d") + height / 2)).cast("int")})
    return out.where((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height)).drop("__d")


def limited_equirectangular(points: DataFrame, camera: Sequence[float], width: int, height: int, fov_h: float, fov_v: float) -> DataFrame:
    """PC-20: within a horizontal and vertical field of view."""
    import math

    dx, dy, dz = F.col("x") - camera[0], F.col("y") - camera[1], F.col("z") - camera[2]
    r = F.sqrt(dx * dx + dy * dy + dz * dz)
    theta, phi = F.atan2(dx, r), F.atan2(-dz, r)
    h, v = math.radians(fov_h), math.radians(fov_v)
    seen = points.withColumns({"r": r, "__t": theta, "__p": phi}).where((F.abs("__t") <= h / 2) & (F.abs("__p") <= v / 2) & (F.col("r") > 0))
    out = seen.withColumns({"u": F.floor((F.col("__t") + h / 2) / h * (width - 1)).cast("int"), "v": F.floor((F.col("__p") + v / 2) / v * (height - 1)).cast("int")})
    return out.drop("__t", "__p")


def birds_eye(points: DataFrame, key: str, cell: float) -> DataFrame:
    """PC-22: counts a cell, over the fullest cell of the group."""
    cells = points.groupBy(key, F.floor(F.col("x") / cell).cast("int").alias("gx"), F.floor(F.col("y") / cell).cast("int").alias("gy")).agg(F.count("*").alias("n"))
    most = cells.groupBy(key).agg(F.max("n").alias("most"))
    return cells.join(most, key).select(key, "gx", "gy", "n", (F.col("n") / F.col("most")).alias("density"))


def interpolated(queries: DataFrame, pixels: DataFrame, by: Sequence[str], radius: int = 20) -> DataFrame:
    """RS-02: inverse-distance mean of the pixels in a square window, else the nearest pixel's value.

    queries (qid, qu, qv), pixels (u, v, value).  Windows meet pixels on cells of the window's size; the nearest
    pixel is looked for only where a window was empty.
    """
    side = radius + 1
    cell = lambda c: F.floor(F.col(c) / side).cast("long")
    ask = queries
    for name, c in (("__i", "qu"), ("__j", "qv")):
        ask = ask.withColumn(name, F.explode(F.sequence(F.floor((F.bround(c, 0) - radius) / side).cast("long"), F.floor((F.bround(c, 0) + radius) / side).cast("long"))))
    near = ask.join(pixels.withColumns({"__i": cell("u"), "__j": cell("v")}), [*by, "__i", "__j"])
    near = near.where((F.abs(F.col("u") - F.bround("qu", 0)) <= radius) & (F.abs(F.col("v") - F.bround("qv", 0)) <= radius))
    weight = 1.0 / (F.hypot(F.col("u") - F.col("qu"), F.col("v") - F.col("qv")) + 1e-6)
    mean = near.groupBy(*by, "qid").agg((F.sum(weight * F.col("value")) / F.sum(weight)).alias("__mean"))
    got = queries.join(mean, [*by, "qid"], "left")
    lone = got.where("__mean IS NULL").drop("__mean")
    far = lone.join(pixels, list(by)).groupBy(*by, "qid").agg(F.min(F.struct(F.hypot(F.col("u") - F.col("qu"), F.col("v") - F.col("qv")).alias("d"), "v", "u", "value")).alias("n"))
    return got.join(far.select(*by, "qid", F.col("n.value").alias("__far")), [*by, "qid"], "left").withColumn("value", F.coalesce("__mean", "__far")).drop("__mean", "__far")


def terrain(points: DataFrame, key: str, cell: float, radius: float) -> DataFrame:
    """RS-08: ground heights on a grid by inverse distance to the cells' centres; groups with under 10 points or under 0.3 m of extent are left out."""
    ok = points.groupBy(key).agg(F.count("*").alias("n"), (F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h")).where("n >= 10 AND w >= 0.3 AND h >= 0.3").select(key)
    own = points.join(ok, key, "left_semi")
    reach = int(radius / cell) + 1
    spread = F.sequence(F.lit(-reach), F.lit(reach))
    cut = own.withColumn("__a", F.explode(spread)).withColumn("__b", F.explode(spread)).withColumns({"gx": (F.floor(F.col("x") / cell) + F.col("__a")).cast("int"), "gy": (F.floor(F.col("y") / cell) + F.col("__b")).cast("int")})
    d = F.hypot(F.col("x") - (F.col("gx") + 0.5) * cell, F.col("y") - (F.col("gy") + 0.5) * cell)
    w = 1.0 / (d * d + 1e-6)
    return cut.where(d <= radius).groupBy(key, "gx", "gy").agg((F.sum(w * F.col("z")) / F.sum(w)).alias("z"))


def viewer_tiles(points: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """PC-24, AG-29, SF-33: extent, class counts as JSON, and of each tile at most most points, chosen by hash, as JSON.

    The limit is the feature: a viewer shows no more.  points need pid.
    """
    classes = points.groupBy(key, "classification").agg(F.count("*").alias("n")).groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("classification", "n"))))).alias("classes"))
    extent = points.groupBy(key).agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max, F.avg) for c in ("x", "y", "z")))
    w = Window.partitionBy(key).orderBy(F.xxhash64(F.lit(7), "pid"), "pid")
    shown = points.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct("k", "x", "y", "z", "intensity", "classification")))).alias("points"))
    return extent.join(classes, key).join(shown, key)


def full_record(points: DataFrame, clips: DataFrame, key: str) -> DataFrame:
    """AG-18, PC-05/16: all statistics of each clip (key, footprint_area, and ring if footprints are known); zeros without points."""
    from ..functions import geo
    from .hulls import hull_areas

    out = clips.join(basic_stats(points, key), key, "left")
    for part in (height_bands, class_stats, shape_scores, height_peaks):
        out = out.join(part(points, key), key, "left")
    out = out.join(hull_areas(points, key).drop("corners"), key, "left")
    area = F.col("footprint_area")
    out = out.withColumns(
        {
            "building_height": F.col("z_range"),
            "point_density": F.when(area > 0, F.col("point_count") / area).otherwise(0.0),
            "spatial_coverage": F.when(area > 0, F.col("convex_hull_area") / area).otherwise(0.0),
            "ground_point_count": F.col("class_2_ground"),
            "noise_point_count": F.col("class_7_noise"),
        }
    )
    if "ring" in clips.columns:
        inside = points.join(clips.select(key, geo.edges(F.col("ring")).alias("__e")), key).groupBy(key).agg((F.count_if(geo.inside_edges(F.col("__e"), F.col("x"), F.col("y"))) / F.count("*")).alias("coverage_ratio"))
        out = out.join(inside, key, "left")
    else:
        out = out.withColumn("coverage_ratio", F.lit(0.0))
    return out.na.fill(0)
