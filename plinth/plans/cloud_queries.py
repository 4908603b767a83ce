"""Queries over point clouds: statistics, quality checks, projections, rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import LAS_CLASSES
from ..operators import hulls, kernels, pointcloud as pc, qa
from ..tables import durable
from .registry import query, r4, rounded

KEY = "tile_id"


def numbered(p: DataFrame) -> DataFrame:
    """Points with an id from all that tells them apart."""
    return p.withColumn("pid", F.concat_ws("-", "ok", "pk", "classification", "x", "y", "z"))


_PID = "concat_ws('-', ok, pk, classification, x, y, z)"
_Q = "quantile_cont"


@query(
    "PC-03 PC-06 PC-07",
    "points",
    sql=f"""SELECT tile_id, count(*) AS point_count, round(min(z), 4) AS z_min, round(max(z), 4) AS z_max, round(max(z) - min(z), 4) AS z_range, round(avg(z), 4) AS z_mean, round(stddev_pop(z), 4) AS z_std, {', '.join(f'round({_Q}(z, {q / 100}), 4) AS z_p{q}' for q in (10, 25, 50, 75, 90))},
    count(*) FILTER (WHERE number_of_returns = 1) AS returns_single, count(*) FILTER (WHERE number_of_returns <> 1) AS returns_multiple, round(avg(intensity), 4) AS intensity_mean, round(stddev_pop(intensity), 4) AS intensity_std FROM points GROUP BY tile_id""",
)
def lidar_basic_stats(p: DataFrame) -> DataFrame:
    return rounded(pc.basic_stats(p, KEY))


_BANDS = ", ".join(f"count(*) FILTER (WHERE z - z0 >= {a} AND z - z0 < {b}) AS pts_{a}_{b}m" for a, b in pc.BANDS[:4])
_DENS = ", ".join(f"round(CASE WHEN count(*) FILTER (WHERE classification = 6) > 10 THEN count(*) FILTER (WHERE classification = 6 AND z - b0 >= {a} AND z - b0 < {b}) / {b - a}.0 ELSE 0.0 END, 4) AS building_density_{a}_{b}m" for a, b in pc.BANDS)
_MULTI = ", ".join(
    f"round(coalesce(count(*) FILTER (WHERE z - z0 >= {a} AND z - z0 < {b} AND number_of_returns > 1) / nullif(count(*) FILTER (WHERE z - z0 >= {a} AND z - z0 < {b}), 0)::DOUBLE, 0.0), 4) AS multi_return_ratio_{a}_{b}m" for a, b in ((0, 10), (10, 20), (20, 30), (30, 50))
)


@query("PC-04 PC-12 PC-14 PF-19", "points", sql=f"WITH r AS (SELECT *, min(z) OVER (PARTITION BY tile_id) AS z0, min(z) FILTER (WHERE classification = 6) OVER (PARTITION BY tile_id) AS b0 FROM points) SELECT tile_id, {_BANDS}, count(*) FILTER (WHERE z - z0 >= 12) AS pts_above_12m, {_DENS}, {_MULTI} FROM r GROUP BY tile_id")
def lidar_height_bands(p: DataFrame) -> DataFrame:
    return rounded(pc.height_bands(p, KEY))


def _n(c: int) -> str:
    return f"count(*) FILTER (WHERE classification = {c})"


def _var(c: int, name: str) -> str:
    return f"round(CASE WHEN {_n(c)} > 3 THEN var_pop(z) FILTER (WHERE classification = {c}) ELSE 0 END, 4) AS {name}"


def _iqr(c: int, name: str) -> str:
    return f"round(CASE WHEN {_n(c)} > 3 THEN {_Q}(z, 0.75) FILTER (WHERE classification = {c}) - {_Q}(z, 0.25) FILTER (WHERE classification = {c}) ELSE 0 END, 4) AS {name}"


@query(
    "PC-08 PC-09 PC-15 AG-19",
    "points",
    sql="SELECT tile_id, " + ", ".join(f"{_n(i)} AS class_{i}_{n}" for i, n in enumerate(LAS_CLASSES)) + f""", round(coalesce(avg(z) FILTER (WHERE classification = 2), 0), 4) AS ground_z_mean, round(coalesce(stddev_pop(z) FILTER (WHERE classification = 2), 0), 4) AS ground_z_std,
    {_n(3)} + {_n(4)} + {_n(5)} AS vegetation_proximity_count, {_var(6, 'roof_z_variance')}, {_var(2, 'ground_height_variance')}, {_iqr(2, 'ground_height_iqr')}, {_var(6, 'building_height_variance')}, {_iqr(6, 'building_height_iqr')} FROM points GROUP BY tile_id""",
)
def lidar_class_counts(p: DataFrame) -> DataFrame:
    return rounded(pc.class_stats(p, KEY))


@query(
    "PC-10 PC-13 Q-25",
    "points",
    sql=f"""WITH b AS (SELECT * FROM points WHERE classification = 6), l AS (SELECT tile_id, count(*) AS nb, min(z) AS bz, max(z) AS tz, {_Q}(x, 0.1) AS x10, {_Q}(x, 0.9) AS x90, {_Q}(y, 0.1) AS y10, {_Q}(y, 0.9) AS y90 FROM b GROUP BY tile_id HAVING count(*) > 100),
    e AS (SELECT b.tile_id, floor((z - bz) / 3.0) AS slab, tz - bz AS rise FROM b JOIN l USING (tile_id) WHERE x < x10 OR x > x90 OR y < y10 OR y > y90), s AS (SELECT tile_id, slab, count(*) AS n, any_value(rise) AS rise FROM e GROUP BY tile_id, slab),
    f AS (SELECT tile_id, sum(n) AS n, max(CASE WHEN slab * 3 < floor(rise) THEN n END) AS most FROM s GROUP BY tile_id),
    g AS (SELECT tile_id, CASE WHEN count(*) > 10 THEN least(coalesce((max(z) - min(z)) / nullif(greatest(max(x) - min(x), max(y) - min(y)), 0), 0), 10) ELSE 0 END AS v, CASE WHEN count(*) > 10 THEN 1 / (1 + stddev_pop(z)) ELSE 0 END AS p FROM points GROUP BY tile_id)
    SELECT g.tile_id, round(v, 4) AS verticality_score, round(p, 4) AS planarity_score, CASE WHEN f.n > 20 AND most > 10 THEN 0.8 ELSE 0.0 END AS facade_alignment_score FROM g LEFT JOIN f USING (tile_id)""",
)
def lidar_shape_scores(p: DataFrame) -> DataFrame:
    return rounded(pc.shape_scores(p, KEY))


@query(
    "WN-10 PC-11",
    "points",
    sql="""WITH b AS (SELECT tile_id, z - min(z) OVER (PARTITION BY tile_id) AS r FROM points WHERE classification = 6), s AS (SELECT tile_id, CAST(ceil((max(r) + 0.5) / 0.5) - 1 AS INTEGER) AS bins FROM b GROUP BY tile_id HAVING count(*) > 10),
    u AS (SELECT * FROM s WHERE bins > 2), c AS (SELECT tile_id, least(CAST(floor(r / 0.5) AS INTEGER), bins - 1) AS bin, count(*) AS n FROM b JOIN u USING (tile_id) WHERE r <= bins * 0.5 GROUP BY ALL),
    g AS (SELECT u.tile_id, k.bin, coalesce(n, 0) AS n FROM u, LATERAL (SELECT unnest(range(u.bins)) AS bin) k LEFT JOIN c ON c.tile_id = u.tile_id AND c.bin = k.bin),
    p AS (SELECT *, lag(n) OVER w AS a, lead(n) OVER w AS z FROM g WINDOW w AS (PARTITION BY tile_id ORDER BY bin)), q AS (SELECT tile_id, bin, (bin - lag(bin) OVER (PARTITION BY tile_id ORDER BY bin)) * 0.5 AS gap FROM p WHERE n > a AND n > z AND n > 10)
    SELECT u.tile_id, count(q.bin) AS building_height_peaks, round(coalesce(stddev_pop(gap), 0), 4) AS building_height_regularity FROM u LEFT JOIN q USING (tile_id) GROUP BY u.tile_id""",
)
def lidar_height_peaks(p: DataFrame) -> DataFrame:
    return rounded(pc.height_peaks(p, KEY))


@query(
    "AG-16 SF-27",
    "points",
    sql=f"SELECT tile_id, round(avg(z), 4) AS ground_elevation_m, round(median(z), 4) AS median, round(min(z), 4) AS min_z, round(max(z), 4) AS max_z, round(stddev_pop(z), 4) AS std, round({_Q}(z, 0.25), 4) AS p25, round({_Q}(z, 0.75), 4) AS p75, count(*) AS ground_points_count, round(least(1.0, count(*) / 100.0), 4) AS confidence_score FROM points WHERE classification = 2 GROUP BY tile_id",
)
def ground_elevation_stats(p: DataFrame) -> DataFrame:
    return rounded(pc.ground_elevation(p, KEY))


@query("AG-17", "points", sql="WITH g AS (SELECT tile_id, avg(z) AS m FROM points WHERE classification = 2 GROUP BY tile_id) SELECT count(*) AS n, round(avg(m), 4) AS mean, round(median(m), 4) AS median, round(stddev_samp(m), 4) AS std, round(max(m) - min(m), 4) AS span, round(sum(m), 3) AS total FROM g")
def stage_summary(p: DataFrame) -> DataFrame:
    g = pc.ground_elevation(p, KEY).select(F.col("ground_elevation_m").alias("m"))
    return g.agg(F.count("*").alias("n"), F.round(F.avg("m"), 4).alias("mean"), F.round(F.percentile("m", 0.5), 4).alias("median"), F.round(F.stddev_samp("m"), 4).alias("std"), F.round(F.max("m") - F.min("m"), 4).alias("span"), F.round(F.sum("m"), 3).alias("total"))


def _grid(cell: float) -> str:
    return f"""b AS (SELECT tile_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, greatest(1, CAST(ceil((max(x) - min(x)) / {cell}) AS INTEGER)) AS nx, greatest(1, CAST(ceil((max(y) - min(y)) / {cell}) AS INTEGER)) AS ny FROM points GROUP BY tile_id),
c AS (SELECT tile_id, least(CAST(floor(coalesce((x - x0) * nx / nullif(x1 - x0, 0), 0)) AS INTEGER), nx - 1) AS i, least(CAST(floor(coalesce((y - y0) * ny / nullif(y1 - y0, 0), 0)) AS INTEGER), ny - 1) AS j, nx * ny AS cells FROM points JOIN b USING (tile_id)),
k AS (SELECT tile_id, i, j, cells, count(*) AS n FROM c GROUP BY ALL), d AS (SELECT tile_id, avg(n) / {cell * cell} AS mean_density, stddev_pop(n) / avg(n) AS variation, count(*) AS filled, any_value(cells) AS cells, 1.0 - count(*) / any_value(cells)::DOUBLE AS void_ratio FROM k GROUP BY tile_id)"""


_GRID = _grid(5.0)


@query("AG-20 AG-21 QA-01", "points", sql=f"WITH {_GRID} SELECT tile_id, round(mean_density, 4) AS mean_density, round(variation, 4) AS variation, filled, cells, round(void_ratio, 4) AS void_ratio FROM d")
def density_grid_voids(p: DataFrame) -> DataFrame:
    return rounded(pc.density_grid(p, KEY, 5.0))


@query("QA-02", "points", sql="WITH b AS (SELECT *, min(x) OVER (PARTITION BY tile_id) AS x0, max(x) OVER (PARTITION BY tile_id) AS x1 FROM points), s AS (SELECT tile_id, CAST(floor((x - x0) * 99 / (x1 - x0)) AS INTEGER) AS strip, z FROM b) SELECT tile_id, strip, count(*) AS n, round(median(z), 4) AS median_z FROM s WHERE strip < 99 GROUP BY ALL HAVING count(*) > 10")
def striping_profile(p: DataFrame) -> DataFrame:
    return rounded(qa.strip_profile(p, KEY))


@query(
    "QA-02",
    "points",
    # heights with stripes: a wave along x
    sql="""WITH q AS (SELECT tile_id, x, sin(x / 4.0) * 3.0 + z * 0.01 AS z FROM points), b AS (SELECT *, min(x) OVER (PARTITION BY tile_id) AS x0, max(x) OVER (PARTITION BY tile_id) AS x1 FROM q), s AS (SELECT tile_id, CAST(floor((x - x0) * 33 / (x1 - x0)) AS INTEGER) AS strip, z FROM b),
    f AS (SELECT tile_id, strip, median(z) AS h FROM s WHERE strip < 33 GROUP BY ALL HAVING count(*) > 10), g AS (SELECT tile_id, h, row_number() OVER (PARTITION BY tile_id ORDER BY strip) - 1 AS i, count(*) OVER (PARTITION BY tile_id) AS n, avg(h) OVER (PARTITION BY tile_id) AS m FROM f),
    w AS (SELECT tile_id, k, any_value(n) AS n, pow(sum((h - m) * cos(2 * pi() * k * i / n)), 2) + pow(sum((h - m) * sin(2 * pi() * k * i / n)), 2) AS p FROM g, range(33) AS r(k) WHERE k < n GROUP BY tile_id, k),
    t AS (SELECT tile_id, any_value(n) AS n, max(p) FILTER (WHERE k BETWEEN 1 AND floor(n / 2) - 1) AS strongest, sum(p) / any_value(n) AS mean FROM w GROUP BY tile_id), a AS (SELECT tile_id, stddev_pop(h) AS amplitude FROM f GROUP BY tile_id)
    SELECT tile_id, 'striping' AS issue_type, 'error' AS severity, round(amplitude, 4) AS value FROM t JOIN a USING (tile_id) WHERE n > 10 AND strongest > 10 * mean AND amplitude > 0.1""",
)
def striping_issues(p: DataFrame) -> DataFrame:
    striped = p.withColumn("z", F.sin(F.col("x") / 4.0) * 3.0 + F.col("z") * 0.01)
    return rounded(qa.striping(striped, KEY, bins=33))


@query(
    "WN-09",
    "points",
    sql=f"""WITH o AS (SELECT tile_id, gps_time, z, {_PID} AS pid FROM points), w AS (SELECT *, gps_time - lag(gps_time) OVER (PARTITION BY tile_id ORDER BY gps_time, pid) AS step, median(z) OVER (PARTITION BY tile_id ORDER BY gps_time, pid ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS a,
    median(z) OVER (PARTITION BY tile_id ORDER BY gps_time, pid ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING) AS b FROM o), l AS (SELECT tile_id, {_Q}(step, 0.95) * 2 AS lim FROM w GROUP BY tile_id) SELECT tile_id, gps_time, step, round(b - a, 4) AS jump FROM w JOIN l USING (tile_id) WHERE step > lim""",
)
def gps_gap_alignment(p: DataFrame) -> DataFrame:
    return rounded(pc.gps_gaps(numbered(p), KEY, ["pid"], factor=2.0))


@query(
    "QA-03",
    "points",
    sql="""WITH m AS (SELECT *, x - avg(x) OVER (PARTITION BY tile_id) AS dx, y - avg(y) OVER (PARTITION BY tile_id) AS dy, z - avg(z) OVER (PARTITION BY tile_id) AS dz FROM points), s AS (SELECT tile_id, count(*) AS n, sum(dx * dx) AS xx, sum(dx * dy) AS xy, sum(dy * dy) AS yy, sum(dx * dz) AS xz, sum(dy * dz) AS yz, sum(dz * dz) AS zz FROM m GROUP BY tile_id),
    c AS (SELECT *, (xz * yy - yz * xy) / (xx * yy - xy * xy) AS a, (yz * xx - xz * xy) / (xx * yy - xy * xy) AS b FROM s) SELECT tile_id, round(a, 4) + 0.0 AS a, round(b, 4) + 0.0 AS b, round(sqrt(greatest(0, (zz - a * xz - b * yz) / n)), 4) AS residual_std FROM c""",
)
def plane_residual(p: DataFrame) -> DataFrame:
    return pc.plane_residual(p, KEY).select(KEY, (F.round("a", 4) + 0.0).alias("a"), (F.round("b", 4) + 0.0).alias("b"), *r4("residual_std"))


@query("QA-04", "points", sql="SELECT tile_id, round(count(*) FILTER (WHERE abs(scan_angle) > 20) / count(*)::DOUBLE, 4) AS edge_share, count(*) FILTER (WHERE abs(scan_angle) > 15) AS n_edge, count(*) FILTER (WHERE abs(scan_angle) < 5) AS n_centre, round(avg(intensity) FILTER (WHERE abs(scan_angle) > 15) / avg(intensity) FILTER (WHERE abs(scan_angle) < 5), 4) AS intensity_ratio FROM points GROUP BY tile_id")
def edge_artifacts(p: DataFrame) -> DataFrame:
    return rounded(qa.edge_shares(p, KEY).drop("i_edge", "i_centre"))


@query("QA-05", "points", sql="WITH c AS (SELECT tile_id, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy FROM points GROUP BY tile_id) SELECT tile_id, round(count(*) FILTER (WHERE sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) < 8.0) / count(*)::DOUBLE, 4) AS centre_share FROM points JOIN c USING (tile_id) GROUP BY tile_id")
def blind_spots(p: DataFrame) -> DataFrame:
    return rounded(qa.centre_share(p, KEY, 8.0))


_D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"
_IDS = f"q AS (SELECT *, {_PID} AS pid FROM points)"


@query("QA-07 JN-19", "points", sql=f"WITH {_IDS}, n AS (SELECT a.tile_id, a.pid, count(*) AS n FROM q a JOIN q b ON a.tile_id = b.tile_id AND {_D2} <= 16 GROUP BY ALL) SELECT tile_id, count(*) AS points, count(*) FILTER (WHERE n < 3) AS outliers, round(count(*) FILTER (WHERE n < 3) / count(*)::DOUBLE, 4) AS ratio FROM n GROUP BY tile_id")
def radius_outliers(p: DataFrame) -> DataFrame:
    return rounded(qa.radius_outliers(numbered(p), KEY, 4.0, 3))


@query(
    "QA-06 JN-18",
    "points",
    sql=f"""WITH {_IDS}, n AS (SELECT a.tile_id, a.pid, sqrt({_D2}) AS d, row_number() OVER (PARTITION BY a.tile_id, a.pid ORDER BY {_D2}, b.pid) AS k FROM q a JOIN q b ON a.tile_id = b.tile_id), m AS (SELECT tile_id, pid, avg(d) AS d FROM n WHERE k BETWEEN 2 AND 6 GROUP BY ALL),
    l AS (SELECT tile_id, avg(d) + 2 * stddev_pop(d) AS lim, count(*) AS points FROM m GROUP BY tile_id) SELECT tile_id, any_value(points) AS points, count(*) FILTER (WHERE d > lim) AS outliers, round(count(*) FILTER (WHERE d > lim) / any_value(points)::DOUBLE, 4) AS ratio FROM m JOIN l USING (tile_id) GROUP BY tile_id""",
)
def knn_outliers(p: DataFrame) -> DataFrame:
    return rounded(qa.knn_outliers(numbered(p), KEY, 5))


@query(
    "QA-06 JN-18",
    "points",
    sql=f"""WITH {_IDS}, s AS (SELECT * REPLACE (CASE WHEN pk % 89 = 0 THEN x + 9000000.0 ELSE x END AS x) FROM q), n AS (SELECT a.tile_id, a.pid, sqrt({_D2}) AS d, row_number() OVER (PARTITION BY a.tile_id, a.pid ORDER BY {_D2}, b.pid) AS k FROM s a JOIN s b ON a.tile_id = b.tile_id),
    m AS (SELECT tile_id, pid, avg(d) AS d FROM n WHERE k BETWEEN 2 AND 6 GROUP BY ALL) SELECT tile_id, count(*) AS points, count(*) FILTER (WHERE d > 1000) AS far, round(max(d), 2) AS farthest, round(min(d), 4) AS closest FROM m GROUP BY tile_id""",
)
def far_points(p: DataFrame) -> DataFrame:
    """Tiles with points 9,000 km off: all have their neighbours' true distances."""
    stray = numbered(p).withColumn("x", F.when(F.col("pk") % 89 == 0, F.col("x") + 9000000.0).otherwise(F.col("x")))
    d = qa.neighbour_distances(stray, KEY, 5, 2.0)
    return d.groupBy(KEY).agg(F.count("*").alias("points"), F.count_if(F.col("d") > 1000).alias("far"), F.round(F.max("d"), 2).alias("farthest"), F.round(F.min("d"), 4).alias("closest"))


@query(
    "QA-09",
    "points",
    sql=f"""WITH {_IDS}, c AS (SELECT tile_id, {_Q}(intensity, 0.95) AS cut FROM q GROUP BY tile_id), h AS (SELECT q.* FROM q JOIN c USING (tile_id) WHERE intensity > cut), m AS (SELECT tile_id FROM h GROUP BY tile_id HAVING count(*) > 10),
    n AS (SELECT a.tile_id, a.pid, a.z, count(*) AS n, median(b.z) AS m FROM h a JOIN m ON a.tile_id = m.tile_id JOIN q b ON a.tile_id = b.tile_id AND {_D2} <= 100 GROUP BY ALL) SELECT tile_id, count(*) AS candidates FROM n WHERE n > 10 AND z - m > 0.5 GROUP BY tile_id""",
)
def ghosting(p: DataFrame) -> DataFrame:
    return qa.ghost_candidates(numbered(p), KEY, 10.0)


@query(
    "QA-10",
    "points",
    sql=f"""WITH {_IDS}, c AS (SELECT tile_id, {_Q}(intensity, 0.8) AS cut FROM q GROUP BY tile_id), h AS (SELECT q.* FROM q JOIN c USING (tile_id) WHERE intensity > cut), m AS (SELECT tile_id FROM h GROUP BY tile_id HAVING count(*) > 50),
    d AS (SELECT tile_id, count(*) / ((max(x) - min(x)) * (max(y) - min(y))) AS mean FROM q GROUP BY tile_id), n AS (SELECT a.tile_id, a.pid, count(*) AS n FROM h a JOIN m ON a.tile_id = m.tile_id JOIN q b ON a.tile_id = b.tile_id AND {_D2} <= 4 GROUP BY ALL)
    SELECT n.tile_id, count(*) AS regions FROM n JOIN d ON n.tile_id = d.tile_id WHERE n / (pi() * 4) > 1.2 * mean GROUP BY n.tile_id""",
)
def blooming(p: DataFrame) -> DataFrame:
    return qa.bloom_regions(numbered(p), KEY, 2.0, 1.2, 0.8)


@query(
    "QA-11 JN-21",
    "points",
    sql=f"""WITH {_IDS}, c AS (SELECT tile_id, {_Q}(z, 0.95) - 6.0 AS cut, median(intensity) AS ai FROM q GROUP BY tile_id), h AS (SELECT q.*, ai FROM q JOIN c USING (tile_id) WHERE z > cut), b AS (SELECT tile_id, count(*) AS n, (max(x) - min(x)) * (max(y) - min(y)) AS area, median(intensity) AS hi, any_value(ai) AS ai FROM h GROUP BY tile_id HAVING count(*) > 100),
    d AS (SELECT a.tile_id, a.pid, sqrt((a.x - o.x) * (a.x - o.x) + (a.y - o.y) * (a.y - o.y)) AS d, row_number() OVER (PARTITION BY a.tile_id, a.pid ORDER BY (a.x - o.x) * (a.x - o.x) + (a.y - o.y) * (a.y - o.y), o.pid) AS k FROM h a JOIN b ON a.tile_id = b.tile_id JOIN h o ON a.tile_id = o.tile_id),
    m AS (SELECT tile_id, avg(d) AS d FROM d WHERE k = 2 GROUP BY tile_id), s AS (SELECT m.tile_id, n, m.d / (0.5 * sqrt(area / n)) AS scatter, hi / ai AS r FROM m JOIN b ON m.tile_id = b.tile_id) SELECT tile_id, n, round(scatter, 4) AS scatter, round(CASE WHEN r < 0.2 THEN 2 * scatter ELSE scatter END, 4) AS score FROM s""",
)
def weather(p: DataFrame) -> DataFrame:
    return rounded(qa.weather_scores(numbered(p), KEY, rise=-6.0))


@query(
    "QA-12",
    "points",
    sql="""WITH s AS (SELECT tile_id, count(*) FILTER (WHERE classification IN (0, 1)) / count(*)::DOUBLE AS u, count(*) FILTER (WHERE classification = 2) / count(*)::DOUBLE AS g, count(DISTINCT classification) AS c FROM points GROUP BY tile_id)
    SELECT tile_id, 'unclassified' AS issue_type, CASE WHEN u > 0.1 THEN 'error' ELSE 'warning' END AS severity, round(u, 4) AS value FROM s WHERE u > 0.02 UNION ALL SELECT tile_id, 'misclassification', 'warning', round(g, 4) FROM s WHERE g < 0.05 UNION ALL SELECT tile_id, 'class_distribution', 'info', CAST(c AS DOUBLE) FROM s""",
)
def class_completeness(p: DataFrame) -> DataFrame:
    return rounded(qa.completeness(p, KEY))


@query(
    "QA-13",
    "points",
    sql="""WITH b AS (SELECT tile_id, min(z) AS z0, median(z) FILTER (WHERE classification = 2) AS gm FROM points GROUP BY tile_id)
    SELECT tile_id, count(*) FILTER (WHERE classification = 2) AS n2, count(*) FILTER (WHERE classification = 6) AS n6, round(count(*) FILTER (WHERE classification = 2 AND z > z0 + 5) / nullif(count(*) FILTER (WHERE classification = 2), 0)::DOUBLE, 4) AS high_ground,
    round(count(*) FILTER (WHERE classification = 6 AND z < gm + 0.5) / nullif(count(*) FILTER (WHERE classification = 6), 0)::DOUBLE, 4) AS low_building,
    round(CASE WHEN count(*) FILTER (WHERE classification = 3) > 100 THEN count(*) FILTER (WHERE classification = 3 AND (z - gm < 0 OR z - gm > 0.5)) / count(*) FILTER (WHERE classification = 3)::DOUBLE END, 4) AS veg3 FROM points JOIN b USING (tile_id) GROUP BY tile_id""",
)
def misclassification(p: DataFrame) -> DataFrame:
    return rounded(qa.class_shares(p, KEY).drop("veg4", "veg5"))


@query(
    "QA-14",
    "points",
    sql=f"""WITH {_IDS}, n AS (SELECT a.tile_id, a.pid, a.classification AS c, b.classification AS o, count(*) AS n FROM q a JOIN q b ON a.tile_id = b.tile_id AND {_D2} <= 64 GROUP BY ALL),
    t AS (SELECT tile_id, pid, c, sum(n) AS al, arg_max(o, (n, -o)) AS top, coalesce(sum(n) FILTER (WHERE o = c), 0) AS same FROM n GROUP BY ALL) SELECT tile_id, round(count(*) FILTER (WHERE al > 10 AND top <> c) / count(*)::DOUBLE, 4) AS noise, round(count(*) FILTER (WHERE al > 10 AND top <> c AND same < 3) / count(*)::DOUBLE, 4) AS isolated FROM t GROUP BY tile_id""",
)
def class_noise(p: DataFrame) -> DataFrame:
    return rounded(qa.class_noise_shares(numbered(p), KEY, 8.0))


@query(
    "QA-15 JN-20",
    "points",
    sql=f"""WITH {_IDS}, g AS (SELECT tile_id FROM q GROUP BY tile_id HAVING count(*) FILTER (WHERE classification = 2) >= 100 AND count(*) FILTER (WHERE classification = 6) >= 100),
    n AS (SELECT a.tile_id, a.pid, count(*) FILTER (WHERE b.classification = 2) AS g, count(*) FILTER (WHERE b.classification = 6) AS b FROM q a JOIN g ON a.tile_id = g.tile_id JOIN q b ON a.tile_id = b.tile_id AND a.classification = 6 AND b.classification IN (2, 6) AND {_D2} <= 36 GROUP BY ALL)
    SELECT tile_id, count(*) AS edge_points, round(1.0 - count(*) FILTER (WHERE g / (g + b)::DOUBLE > 0.3 AND g / (g + b)::DOUBLE < 0.7) / count(*)::DOUBLE, 4) AS quality FROM n WHERE g > 0 GROUP BY tile_id HAVING count(*) > 20""",
)
def edge_class(p: DataFrame) -> DataFrame:
    return rounded(qa.edge_quality(numbered(p), KEY, 6.0, 20))


@query(
    "QA-16",
    "points",
    sql=f"""WITH {_IDS}, m AS (SELECT tile_id FROM q WHERE classification = 7 GROUP BY tile_id HAVING count(*) >= 10), n AS (SELECT a.tile_id, a.pid, count(*) AS n FROM q a JOIN m ON a.tile_id = m.tile_id JOIN q b ON a.tile_id = b.tile_id AND a.classification = 7 AND {_D2} <= 36 GROUP BY ALL)
    SELECT tile_id, count(*) AS noise_points, round(count(*) FILTER (WHERE n > 5) / count(*)::DOUBLE, 4) AS crowded FROM n GROUP BY tile_id""",
)
def noise_isolation(p: DataFrame) -> DataFrame:
    return rounded(qa.noise_isolation(numbered(p), KEY, 6.0))


_ISSUES = f"""{_GRID}, i AS (SELECT tile_id, 'low_density' AS t, CASE WHEN mean_density < 1 THEN 'critical' ELSE 'error' END AS s FROM d WHERE mean_density < 2 UNION ALL SELECT tile_id, 'density_variation', 'warning' FROM d WHERE variation > 0.5
UNION ALL SELECT tile_id, 'data_void', CASE WHEN void_ratio > 0.1 THEN 'error' ELSE 'warning' END FROM d WHERE void_ratio > 0.05), r AS (SELECT d.tile_id, mean_density, {', '.join(f"count(*) FILTER (WHERE s = '{s}') AS issues_{s}" for s in qa.SEVERITIES)}, coalesce(string_agg(DISTINCT t, ',' ORDER BY t), '') AS issue_types,
CASE WHEN mean_density >= 8 THEN 'QL1' WHEN mean_density >= 2 THEN 'QL2' WHEN mean_density >= 0.5 THEN 'QL3' END AS quality_level, count(*) FILTER (WHERE s IN ('error', 'critical')) > 0 AS needs_correction FROM d LEFT JOIN i ON d.tile_id = i.tile_id GROUP BY d.tile_id, mean_density)"""


def reports(p: DataFrame) -> DataFrame:
    """Issues and densities come from one row a tile, written: the points are counted once, and no task holds more than that."""
    grid = durable(pc.density_grid(p.select(KEY, "x", "y"), KEY, 5.0), "grid")
    return qa.rule_report(grid, KEY, ["density"])


@query("AG-22 SF-32 QA-18 SF-06 SK-09", "points", sql=f"WITH {_ISSUES} SELECT tile_id, round(mean_density, 4) AS mean_density, {', '.join(f'issues_{s}' for s in qa.SEVERITIES)}, issue_types, quality_level, needs_correction FROM r")
def qa_report_rows(p: DataFrame) -> DataFrame:
    return rounded(reports(p))


@query(
    "AG-23",
    "points",
    sql=f"WITH {_ISSUES} SELECT count(*) AS tiles, count(*) FILTER (WHERE needs_correction) AS to_correct, round(avg(mean_density), 4) AS mean_density, {', '.join(f'''count(*) FILTER (WHERE quality_level = '{q}') AS {q.lower()}''' for q in ('QL1', 'QL2', 'QL3'))}, {', '.join(f'CAST(sum(issues_{s}) AS BIGINT) AS issues_{s}' for s in qa.SEVERITIES)} FROM r",
)
def qa_summary(p: DataFrame) -> DataFrame:
    return rounded(qa.summary(reports(p)))


@query("AG-23 SL-04", "points", sql=f"WITH {_ISSUES} SELECT t AS issue_type, count(DISTINCT tile_id) AS n FROM i GROUP BY t ORDER BY n DESC, t LIMIT 5")
def qa_issue_frequency(p: DataFrame) -> DataFrame:
    return qa.issue_frequency(reports(p)).orderBy(F.desc("n"), "issue_type").limit(5)


@query("PF-13 SL-03 Q-21", "points", sql=f"WITH {_ISSUES} SELECT tile_id, issues_warning + issues_error + issues_critical AS total_issues FROM r WHERE needs_correction AND regexp_matches(issue_types, 'density') AND issues_critical > 0 ORDER BY total_issues DESC, tile_id LIMIT 20")
def qa_issues_list(p: DataFrame) -> DataFrame:
    return qa.listed(reports(p), KEY, "density", "critical").select(KEY, "total_issues")


_SHARE = "count(*) FILTER (WHERE {0}) / nullif(count(*) FILTER (WHERE {1}), 0)::DOUBLE"
_VEG = {3: "z - gm < 0 OR z - gm > 0.5", 4: "z - gm < 0.5 OR z - gm > 2.0", 5: "z - gm < 2.0"}
#: check, type, severity, value, table and condition
_AGGREGATE_RULES = (
    ("density", "low_density", "CASE WHEN mean_density < 1 THEN 'critical' ELSE 'error' END", "mean_density", "d", "mean_density < 2"),
    ("density", "density_variation", "'warning'", "variation", "d", "variation > 0.5"),
    ("density", "data_void", "CASE WHEN void_ratio > 0.1 THEN 'error' ELSE 'warning' END", "void_ratio", "d", "void_ratio > 0.05"),
    ("striping", "striping", "'error'", "amplitude", "stripes", "n > 10 AND strongest > 10 * mean AND amplitude > 0.1"),
    ("alignment", "misalignment", "'error'", "abs(b - a)", "jumps", "abs(b - a) > 0.1"),
    ("alignment", "misalignment", "'warning'", "residual", "plane", "residual > 0.5"),
    ("edge_artifacts", "edge_artifacts", "'warning'", "edge_share", "e", "edge_share > 0.1"),
    ("edge_artifacts", "intensity_banding", "'warning'", "i_edge / i_centre", "e", "n_edge > 100 AND n_centre > 100 AND (i_edge / i_centre < 0.5 OR i_edge / i_centre > 2)"),
    ("blind_spots", "blind_spots", "'info'", "centre_share", "e", "centre_share < 0.001"),
    ("completeness", "unclassified", "CASE WHEN u > 0.1 THEN 'error' ELSE 'warning' END", "u", "e", "u > 0.02"),
    ("completeness", "misclassification", "'warning'", "g", "e", "g < 0.05"),
    ("completeness", "class_distribution", "'info'", "classes", "e", "true"),
    ("misclassification", "misclassification", "'warning'", "high_ground", "e", "n2 > 10 AND high_ground > 0.01"),
    ("misclassification", "misclassification", "'warning'", "low_building", "e", "n2 > 10 AND n6 > 10 AND low_building > 0.1"),
    *(("misclassification", "misclassification", "'warning'", f"veg{v}", "e", f"n2 > 10 AND n{v} > 100 AND veg{v} > 0.2") for v in _VEG),
)


@query(
    "QA-01 QA-02 QA-03 QA-04 QA-05 QA-12 QA-13 QA-17",
    "points",
    sql=f"""WITH {_grid(1.0)}, h AS (SELECT tile_id, min(z) AS z0, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, median(z) FILTER (WHERE classification = 2) AS gm FROM points GROUP BY tile_id), q AS (SELECT * FROM points JOIN b USING (tile_id) JOIN h USING (tile_id)),
    e AS (SELECT tile_id, count(*) FILTER (WHERE abs(scan_angle) > 20) / count(*)::DOUBLE AS edge_share, count(*) FILTER (WHERE abs(scan_angle) > 15) AS n_edge, count(*) FILTER (WHERE abs(scan_angle) < 5) AS n_centre, avg(intensity) FILTER (WHERE abs(scan_angle) > 15) AS i_edge, avg(intensity) FILTER (WHERE abs(scan_angle) < 5) AS i_centre,
    count(*) FILTER (WHERE sqrt(pow(x - (x0 + x1) / 2, 2) + pow(y - (y0 + y1) / 2, 2)) < 0.5) / count(*)::DOUBLE AS centre_share, count(*) FILTER (WHERE classification IN (0, 1)) / count(*)::DOUBLE AS u, count(*) FILTER (WHERE classification = 2) / count(*)::DOUBLE AS g, count(DISTINCT classification) AS classes,
    {', '.join(f'count(*) FILTER (WHERE classification = {v}) AS n{v}' for v in (2, 3, 4, 5, 6))}, {_SHARE.format('classification = 2 AND z > z0 + 5', 'classification = 2')} AS high_ground, {_SHARE.format('classification = 6 AND z < gm + 0.5', 'classification = 6')} AS low_building,
    {', '.join(f"{_SHARE.format(f'classification = {v} AND ({w})', f'classification = {v}')} AS veg{v}" for v, w in _VEG.items())} FROM q GROUP BY tile_id),
    s1 AS (SELECT tile_id, CAST(floor((x - x0) * 99 / nullif(x1 - x0, 0)) AS INTEGER) AS strip, z FROM q), s2 AS (SELECT tile_id, strip, median(z) AS v FROM s1 WHERE strip < 99 GROUP BY ALL HAVING count(*) > 10),
    s3 AS (SELECT tile_id, v, row_number() OVER (PARTITION BY tile_id ORDER BY strip) - 1 AS i, count(*) OVER (PARTITION BY tile_id) AS n, avg(v) OVER (PARTITION BY tile_id) AS m FROM s2),
    s4 AS (SELECT tile_id, k, any_value(n) AS n, pow(sum((v - m) * cos(2 * pi() * k * i / n)), 2) + pow(sum((v - m) * sin(2 * pi() * k * i / n)), 2) AS p FROM s3, range(99) AS r(k) WHERE k < n GROUP BY tile_id, k),
    stripes AS (SELECT * FROM (SELECT tile_id, any_value(n) AS n, max(p) FILTER (WHERE k BETWEEN 1 AND floor(n / 2) - 1) AS strongest, sum(p) / any_value(n) AS mean FROM s4 GROUP BY tile_id) JOIN (SELECT tile_id, stddev_pop(v) AS amplitude FROM s2 GROUP BY tile_id) USING (tile_id)),
    g1 AS (SELECT tile_id, gps_time, z, {_PID} AS pid FROM points), g2 AS (SELECT *, gps_time - lag(gps_time) OVER (PARTITION BY tile_id ORDER BY gps_time, pid) AS step, median(z) OVER (PARTITION BY tile_id ORDER BY gps_time, pid ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS a,
    median(z) OVER (PARTITION BY tile_id ORDER BY gps_time, pid ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING) AS b FROM g1), g3 AS (SELECT tile_id, {_Q}(step, 0.95) * 10 AS lim FROM g2 GROUP BY tile_id), jumps AS (SELECT * FROM g2 JOIN g3 USING (tile_id) WHERE step > lim),
    p1 AS (SELECT tile_id, count(*) AS n, {', '.join(f'sum(({a} - m{a}) * ({c} - m{c})) AS {a}{c}' for a, c in pc.PLANE_SUMS)} FROM q GROUP BY tile_id), p2 AS (SELECT *, (xz * yy - yz * xy) / nullif(xx * yy - xy * xy, 0) AS pa, (yz * xx - xz * xy) / nullif(xx * yy - xy * xy, 0) AS pb FROM p1),
    plane AS (SELECT tile_id, sqrt(greatest(0, (zz - pa * xz - pb * yz) / n)) AS residual FROM p2) {' UNION ALL '.join(f"SELECT tile_id, '{kind}' AS issue_type, {severity} AS severity, round(CAST({value} AS DOUBLE), 4) AS value, '{check}' AS check_name FROM {table} WHERE {when}" for check, kind, severity, value, table, when in _AGGREGATE_RULES)}""",
)
def qa_all_aggregate_checks(p: DataFrame) -> DataFrame:
    found = qa.run_checks(numbered(p), KEY, ["density", "striping", "alignment", "edge_artifacts", "blind_spots", "completeness", "misclassification"])
    return rounded(found.withColumnRenamed("check", "check_name"))


@query("QA-01 QA-02 QA-03 QA-04 QA-05 QA-06 QA-07 QA-08 QA-09 QA-10 QA-11 QA-12 QA-13 QA-14 QA-15 QA-16 QA-17", "points")
def qa_all_checks(p: DataFrame) -> DataFrame:
    """Every check; each one's measures have an oracle of their own above."""
    return rounded(qa.run_checks(numbered(p), KEY))


_CAM = (50.0, 25.0, 3.0)
_EQ = f"""e AS (SELECT *, {_PID} AS pid, sqrt((x - 50) * (x - 50) + (y - 25) * (y - 25) + (z - 3) * (z - 3)) AS r FROM points), u AS (SELECT *, least(greatest(CAST(floor((atan2(x - 50, y - 25) / pi() + 1) / 2 * 359) AS INTEGER), 0), 359) AS u,
least(greatest(CAST(floor(acos(least(1.0, greatest(-1.0, (z - 3) / r))) / pi() * 179) AS INTEGER), 0), 179) AS v FROM e WHERE r > 0 AND r < 9999)"""


@query("PC-17 SF-26 WN-12 Q-16", "points", sql=f"WITH {_EQ}, k AS (SELECT *, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r, pid) AS n FROM u) SELECT tile_id, u, v, round(r, 4) AS r, pid FROM k WHERE n = 1")
def equirect_zbuffer_nearest(p: DataFrame) -> DataFrame:
    return rounded(pc.zbuffer(pc.equirectangular(numbered(p), _CAM, 360, 180), [KEY], ["pid"]))


@query("PC-17 Q-03 WN-12", "points", sql=f"WITH {_EQ}, k AS (SELECT *, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r DESC, pid DESC) AS n FROM u) SELECT tile_id, u, v, round(r, 4) AS r, pid FROM k WHERE n = 1")
def equirect_zbuffer_farthest(p: DataFrame) -> DataFrame:
    return rounded(pc.zbuffer(pc.equirectangular(numbered(p), _CAM, 360, 180), [KEY], ["pid"], "farthest"))


@query(
    "PC-18",
    "points",
    sql=f"""WITH {_EQ}, a AS (SELECT tile_id, u, v, classification, pid, r, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r, classification, pid) AS n FROM u WHERE classification IN (2, 6)), b AS (SELECT tile_id, u, v, classification, pid, r, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r DESC, classification DESC, pid DESC) AS n FROM u),
    o AS (SELECT * FROM a WHERE n = 1), x AS (SELECT * FROM b WHERE n = 1 AND classification NOT IN (2, 6)) SELECT tile_id, u, v, classification, pid FROM o UNION ALL SELECT tile_id, u, v, classification, pid FROM x ANTI JOIN o USING (tile_id, u, v)""",
)
def zbuffer_class_aware(p: DataFrame) -> DataFrame:
    return pc.class_aware(pc.equirectangular(numbered(p), _CAM, 360, 180), [KEY], ["classification", "pid"]).drop("r")


@query("AG-28", "points", sql=f"WITH {_EQ} SELECT tile_id, count(DISTINCT (u, v)) AS pixels, round(count(DISTINCT (u, v)) * 100.0 / (360 * 180), 4) AS coverage FROM u GROUP BY tile_id")
def raster_coverage(p: DataFrame) -> DataFrame:
    z = pc.zbuffer(pc.equirectangular(numbered(p), _CAM, 360, 180), [KEY], ["pid"])
    return rounded(z.groupBy(KEY).agg(F.count("*").alias("pixels"), (F.count("*") * 100.0 / (360 * 180)).alias("coverage")))


@query(
    "PC-19",
    "points",
    sql=f"""WITH e AS (SELECT *, {_PID} AS pid, sqrt((x - 50) * (x - 50) + (y + 30) * (y + 30) + (z - 3) * (z - 3)) AS r FROM points WHERE y + 30 > 0), u AS (SELECT *, CAST(floor(160 / tan(radians(90.0) / 2) * (x - 50) / (y + 30) + 160) AS INTEGER) AS u, CAST(239 - floor(160 / tan(radians(90.0) / 2) * (z - 3) / (y + 30) + 120) AS INTEGER) AS v FROM e),
    k AS (SELECT *, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r, pid) AS n FROM u WHERE u BETWEEN 0 AND 319 AND v BETWEEN 0 AND 239) SELECT tile_id, u, v, round(r, 4) AS r, pid FROM k WHERE n = 1""",
)
def perspective_projection(p: DataFrame) -> DataFrame:
    return rounded(pc.zbuffer(pc.perspective(numbered(p), (50.0, -30.0, 3.0), 320, 240, 90.0), [KEY], ["pid"]))


@query(
    "PC-20",
    "points",
    sql=f"""WITH e AS (SELECT *, {_PID} AS pid, sqrt((x - 50) * (x - 50) + (y - 25) * (y - 25) + (z - 3) * (z - 3)) AS r FROM points), a AS (SELECT *, atan2(x - 50, r) AS t, atan2(3 - z, r) AS p FROM e WHERE r > 0),
    u AS (SELECT *, CAST(floor((t + radians(120) / 2) / radians(120) * 319) AS INTEGER) AS u, CAST(floor((p + radians(90) / 2) / radians(90) * 239) AS INTEGER) AS v FROM a WHERE abs(t) <= radians(120) / 2 AND abs(p) <= radians(90) / 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r, pid) AS n FROM u) SELECT tile_id, u, v, round(r, 4) AS r, pid FROM k WHERE n = 1""",
)
def limited_view_projection(p: DataFrame) -> DataFrame:
    return rounded(pc.zbuffer(pc.limited_equirectangular(numbered(p), _CAM, 320, 240, 120.0, 90.0), [KEY], ["pid"]))


@query("PC-22", "points", sql="WITH c AS (SELECT tile_id, CAST(floor(x / 5.0) AS INTEGER) AS gx, CAST(floor(y / 5.0) AS INTEGER) AS gy, count(*) AS n FROM points GROUP BY ALL) SELECT tile_id, gx, gy, n, round(n / max(n) OVER (PARTITION BY tile_id)::DOUBLE, 4) AS density FROM c")
def bev_density(p: DataFrame) -> DataFrame:
    return rounded(pc.birds_eye(p, KEY, 5.0))


@query("RS-01", "points", sql=f"WITH {_EQ} SELECT tile_id, round(avg(r) FILTER (WHERE classification = 6), 4) AS gapfill FROM u GROUP BY tile_id")
def gapfill_depth(p: DataFrame) -> DataFrame:
    e = pc.equirectangular(numbered(p), _CAM, 360, 180)
    return rounded(e.groupBy(KEY).agg(F.avg(F.when(F.col("classification") == 6, F.col("r"))).alias("gapfill")))


_PIX = "p AS (SELECT tile_id, CAST(floor(x * 3) AS INTEGER) AS u, CAST(floor(y * 4) AS INTEGER) AS v, min(z) AS value FROM points GROUP BY ALL), a AS (SELECT tile_id, k AS qid, CAST((tile_id * 31 + k * 97) % 330 AS DOUBLE) + 0.3 AS qu, CAST((tile_id * 17 + k * 41) % 210 AS DOUBLE) + 0.2 AS qv FROM (SELECT DISTINCT tile_id FROM points), (SELECT unnest(range(5)) AS k))"


@query(
    "RS-02 SC-15",
    "points",
    sql=f"""WITH {_PIX}, w AS (SELECT a.tile_id, qid, sqrt((u - qu) * (u - qu) + (v - qv) * (v - qv)) AS d, value, u, v, abs(u - round_even(qu, 0)) <= 20 AND abs(v - round_even(qv, 0)) <= 20 AS inside FROM a JOIN p ON a.tile_id = p.tile_id)
    SELECT tile_id, qid, round(coalesce(sum(value / (d + 1e-6)) FILTER (WHERE inside) / sum(1 / (d + 1e-6)) FILTER (WHERE inside), arg_min(value, (d, v, u))), 4) AS value FROM w GROUP BY tile_id, qid""",
)
def idw_lookup(p: DataFrame) -> DataFrame:
    pixels = p.groupBy(KEY, F.floor(F.col("x") * 3).cast("int").alias("u"), F.floor(F.col("y") * 4).cast("int").alias("v")).agg(F.min("z").alias("value"))
    ask = p.select(KEY).distinct().select(KEY, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("qid"))
    ask = ask.withColumns({"qu": ((F.col(KEY) * 31 + F.col("qid") * 97) % 330).cast("double") + 0.3, "qv": ((F.col(KEY) * 17 + F.col("qid") * 41) % 210).cast("double") + 0.2})
    return pc.interpolated(ask, pixels, [KEY]).select(KEY, "qid", *r4("value"))


@query(
    "RS-08 SK-13",
    "points",
    sql="""WITH p AS (SELECT * FROM points WHERE classification = 2), o AS (SELECT tile_id FROM p GROUP BY tile_id HAVING count(*) >= 10 AND max(x) - min(x) >= 0.3 AND max(y) - min(y) >= 0.3), s AS (SELECT unnest(range(-2, 3)) AS s),
    c AS (SELECT tile_id, CAST(floor(x / 4) AS INTEGER) + a.s AS gx, CAST(floor(y / 4) AS INTEGER) + b.s AS gy, x, y, z FROM p JOIN o USING (tile_id), s a, s b), d AS (SELECT *, sqrt((x - (gx + 0.5) * 4) * (x - (gx + 0.5) * 4) + (y - (gy + 0.5) * 4) * (y - (gy + 0.5) * 4)) AS d FROM c)
    SELECT tile_id, gx, gy, round(sum(z / (d * d + 1e-6)) / sum(1 / (d * d + 1e-6)), 4) AS z FROM d WHERE d <= 6 GROUP BY ALL""",
)
def idw_dtm(p: DataFrame) -> DataFrame:
    return rounded(pc.terrain(p.where("classification = 2"), KEY, 4.0, 6.0))


@query("PC-21", "points", sql=f"WITH {_IDS}, n AS (SELECT a.tile_id, a.pid AS pid, b.pid AS oid FROM q a JOIN q b ON a.tile_id = b.tile_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 4), c AS (SELECT tile_id, pid FROM n GROUP BY ALL HAVING count(*) >= 4) SELECT tile_id, count(DISTINCT pid) AS kept FROM n WHERE EXISTS (SELECT 1 FROM c WHERE c.tile_id = n.tile_id AND c.pid = n.oid) GROUP BY tile_id")
def dense_points(p: DataFrame) -> DataFrame:
    return qa.dense_noise(numbered(p), KEY, 2.0, 4).groupBy(KEY).agg(F.count("*").alias("kept"))


@query(
    "GE-08 GE-09 PC-05",
    "points",
    # a corner has no point in one of the four directions; an edge has all points on its left and none beyond its ends
    sql="""WITH p AS (SELECT DISTINCT tile_id, x, y FROM points), c AS (SELECT a.tile_id, a.x, a.y FROM p a JOIN p b USING (tile_id) GROUP BY ALL HAVING NOT (bool_or(b.x > a.x AND b.y > a.y) AND bool_or(b.x > a.x AND b.y < a.y) AND bool_or(b.x < a.x AND b.y > a.y) AND bool_or(b.x < a.x AND b.y < a.y))),
    k AS (SELECT tile_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, (b.x - a.x) * (p.y - a.y) - (b.y - a.y) * (p.x - a.x) AS side, ((b.x - a.x) * (p.x - a.x) + (b.y - a.y) * (p.y - a.y)) / (pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS along FROM c a JOIN c b USING (tile_id) JOIN c p USING (tile_id) WHERE a.x <> b.x OR a.y <> b.y),
    e AS (SELECT tile_id, ax, ay, bx, by_ FROM k GROUP BY ALL HAVING min(side) >= -1e-7 AND bool_and(abs(side) > 1e-7 OR along BETWEEN -1e-9 AND 1 + 1e-9)) SELECT tile_id, round(sum(ax * by_ - bx * ay) / 2, 4) AS convex_hull_area, CAST(count(*) AS INTEGER) AS corners FROM e GROUP BY tile_id""",
)
def hull_areas(p: DataFrame) -> DataFrame:
    return rounded(hulls.hull_areas(p, KEY))


@query("PC-23 QA-08", "points")
def noise_levels(p: DataFrame) -> DataFrame:
    return rounded(qa.noise_levels(numbered(p), [KEY], 10))


@query("PC-02", "points")
def cloth_ground_points(p: DataFrame) -> DataFrame:
    return kernels.ground_points(numbered(p), KEY).groupBy(KEY).agg(F.count("*").alias("n"), F.round(F.avg("z"), 4).alias("mean_z"))


_RASTER = f"""{_EQ}, g AS (SELECT tile_id, u, v, classification, z, r AS depth, row_number() OVER (PARTITION BY tile_id, u, v ORDER BY r, classification, pid, z) AS n FROM u), px AS (SELECT * FROM g WHERE n = 1),
bx AS (SELECT tile_id, k AS box, CAST((tile_id * 29 + k * 83) % 300 AS DOUBLE) AS x1, CAST((tile_id * 13 + k * 37) % 150 AS DOUBLE) AS y1 FROM (SELECT DISTINCT tile_id FROM points), (SELECT unnest(range(20)) AS k)), b AS (SELECT *, x1 + 40.5 AS x2, y1 + 20.5 AS y2 FROM bx)"""


def _raster(p: DataFrame) -> DataFrame:
    z = pc.zbuffer(pc.equirectangular(numbered(p), _CAM, 360, 180), [KEY], ["classification", "pid", "z"])
    return z.withColumnRenamed("r", "depth")


@query(
    "RS-03 RS-04 RS-05 RS-12",
    "points",
    sql=f"""WITH {_RASTER}, s AS (SELECT b.*, t.z AS tz, o.z AS bz, l.depth AS ld, r.depth AS rd, (SELECT avg(depth) FROM px g WHERE g.tile_id = b.tile_id AND classification = 6) AS gap FROM b
    LEFT JOIN px t ON t.tile_id = b.tile_id AND t.u = CAST(floor((x1 + x2) / 2) AS INTEGER) AND t.v = CAST(floor(y1) AS INTEGER) LEFT JOIN px o ON o.tile_id = b.tile_id AND o.u = CAST(floor((x1 + x2) / 2) AS INTEGER) AND o.v = CAST(floor(least(y2, 179)) AS INTEGER)
    LEFT JOIN px l ON l.tile_id = b.tile_id AND l.u = CAST(floor(x1) AS INTEGER) AND l.v = CAST(floor((y1 + y2) / 2) AS INTEGER) LEFT JOIN px r ON r.tile_id = b.tile_id AND r.u = CAST(floor(least(x2, 359)) AS INTEGER) AND r.v = CAST(floor((y1 + y2) / 2) AS INTEGER)),
    a AS (SELECT *, coalesce(ld, gap) AS dl, coalesce(rd, gap) AS dr, radians((2 * floor(x1) / 360 - 1) * (360 * 180.0 / 11000) / 2) AS fl, radians((2 * floor(least(x2, 359)) / 360 - 1) * (360 * 180.0 / 11000) / 2) AS fr,
    radians((2750.0 - (floor(y1) + 1375)) * (180.0 / 5500)) AS tt, radians((2750.0 - (floor(least(y2, 179)) + 1375)) * (180.0 / 5500)) AS tb FROM s),
    m AS (SELECT *, sqrt((dr * sin(fr) - dl * sin(fl)) * (dr * sin(fr) - dl * sin(fl)) + (dr * cos(fr) - dl * cos(fl)) * (dr * cos(fr) - dl * cos(fl))) AS w, CASE WHEN tz IS NULL OR bz IS NULL THEN gap * (sin(tt) - sin(tb)) ELSE tz - bz END AS h FROM a)
    SELECT tile_id, box, round(tz, 4) AS "top", round(bz, 4) AS bottom, round(w, 4) AS real_width, round(h, 4) + 0.0 AS real_height FROM m""",
)
def feature_properties(p: DataFrame) -> DataFrame:
    from ..operators import raster

    n = F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))
    boxes = p.select(KEY).distinct().select(KEY, F.explode(n).alias("box"))
    boxes = boxes.withColumns({"x1": ((F.col(KEY) * 29 + F.col("box") * 83) % 300).cast("double"), "y1": ((F.col(KEY) * 13 + F.col("box") * 37) % 150).cast("double")})
    boxes = boxes.withColumns({"x2": F.col("x1") + 40.5, "y2": F.col("y1") + 20.5})
    out = raster.feature_properties(boxes, _raster(p), KEY, 360, 180)
    return out.select(KEY, "box", *r4("top", "bottom", "real_width"), (F.round("real_height", 4) + 0.0).alias("real_height"))


@query("SF-24 RS-09", "points", sql=f"WITH {_RASTER} SELECT tile_id, coalesce(min(CASE WHEN classification = 6 THEN u - 90 END), 0) AS x1, coalesce(min(CASE WHEN classification = 6 THEN v - 60 END), 0) AS y1, coalesce(max(CASE WHEN classification = 6 THEN u - 90 END), 0) AS x2, coalesce(max(CASE WHEN classification = 6 THEN v - 60 END), 0) AS y2 FROM px WHERE u >= 90 AND u < 270 AND v >= 60 AND v < 120 GROUP BY tile_id")
def mask_boxes(p: DataFrame) -> DataFrame:
    from ..operators import raster

    inside = raster.crop(_raster(p), 90, 270, 60, 120)
    return raster.bounding_box(inside.withColumn("value", (F.col("classification") == 6).cast("int")), [KEY])


@query("RS-06 RS-07 RS-10", "points")
def raster_kernels(p: DataFrame) -> DataFrame:
    from ..operators import raster

    spots = p.groupBy(KEY).agg(F.lit(180.0).alias("x"), F.lit(90.0).alias("y"))
    small = raster.surveyed(_raster(p), spots, KEY, (180, 360), (90, 180), least=2)
    return rounded(small.groupBy(KEY).agg(F.count("*").alias("pixels"), F.avg("value").alias("mean"), F.first("nearest_ground_m").alias("nearest_ground_m")))


@query("SF-29", "points", sql="SELECT tile_id, ok, pk, round(CASE WHEN max(intensity) OVER w = min(intensity) OVER w THEN 0.5 ELSE (intensity - min(intensity) OVER w) / (max(intensity) OVER w - min(intensity) OVER w)::DOUBLE END, 4) AS shade FROM points WINDOW w AS (PARTITION BY tile_id)")
def intensity_shades(p: DataFrame) -> DataFrame:
    span = p.groupBy(KEY).agg(F.min("intensity").alias("lo"), F.max("intensity").alias("hi"))
    shade = F.when(F.col("hi") == F.col("lo"), 0.5).otherwise((F.col("intensity") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return p.join(span, KEY).select(KEY, "ok", "pk", F.round(shade, 4).alias("shade"))


_EXTENT = ", ".join(f"round(avg({c}), 4) AS avg_{c}" if f == "avg" else f"{f}({c}) AS {f}_{c}" for f in ("min", "max", "avg") for c in "xyz")


@query(
    "PC-24 SF-33 AG-29 SL-05",
    "points",
    sql=f"""WITH c AS (SELECT tile_id, classification, count(*) AS n FROM points GROUP BY ALL), k AS (SELECT tile_id, '{{' || string_agg('"' || classification || '":' || n, ',' ORDER BY classification) || '}}' AS classes FROM c GROUP BY tile_id),
    b AS (SELECT tile_id, {_EXTENT}, count(*) AS shown, round(sum(z), 3) AS sum_z, CAST(sum(intensity) AS BIGINT) AS sum_intensity FROM points GROUP BY tile_id) SELECT * FROM b JOIN k USING (tile_id)""",
)
def viewer_tiles(p: DataFrame) -> DataFrame:
    """What the viewer is served, read back from its JSON; tiles here have fewer points than it shows."""
    out = pc.viewer_tiles(numbered(p), KEY).withColumn("shown", F.from_json("points", "array<struct<x: double, y: double, z: double, intensity: bigint, classification: int>>"))
    total = lambda f, zero: F.aggregate("shown", zero, lambda a, q: a + q[f])
    told = out.withColumns({"sum_z": F.round(total("z", F.lit(0.0)), 3), "sum_intensity": total("intensity", F.lit(0).cast("long")), "shown": F.size("shown").cast("long")})
    return told.select(KEY, *(f"{f}_{c}" for f in ("min", "max") for c in "xyz"), *(F.round(f"avg_{c}", 4).alias(f"avg_{c}") for c in "xyz"), "classes", "shown", "sum_z", "sum_intensity")


@query(
    "AG-18 PC-16 JN-16",
    "points",
    sql="""WITH c AS (SELECT DISTINCT tile_id FROM points UNION ALL SELECT DISTINCT tile_id + 1000000 FROM points), s AS (SELECT tile_id, count(*) AS n, min(z) AS lo, max(z) - min(z) AS rise, count(*) FILTER (WHERE classification = 6) AS b, count(*) FILTER (WHERE number_of_returns = 1) AS r, avg(intensity) AS i FROM points GROUP BY tile_id)
    SELECT c.tile_id, coalesce(n, 0) AS point_count, round(coalesce(lo, 0), 4) AS z_min, round(coalesce(rise, 0), 4) AS building_height, coalesce(b, 0) AS class_6_building, coalesce(r, 0) AS returns_single, round(coalesce(i, 0), 4) AS intensity_mean, round(coalesce(n / 5000.0, 0), 4) AS point_density FROM c LEFT JOIN s ON c.tile_id = s.tile_id""",
)
def lidar_record(p: DataFrame) -> DataFrame:
    """The whole record of each clip, zeros for clips without points; a few of its fields are compared."""
    clips = p.select(KEY).distinct()
    clips = clips.union(clips.select(F.col(KEY) + 1_000_000)).withColumn("footprint_area", F.lit(5000.0))
    r = pc.full_record(p, clips, KEY)
    return r.select(KEY, "point_count", *r4("z_min", "building_height"), "class_6_building", "returns_single", *r4("intensity_mean", "point_density"))


@query("SF-35", "points", sql="SELECT tile_id, ok, pk, classification, CAST(least(255, round((CASE classification WHEN 2 THEN 139 WHEN 6 THEN 255 ELSE 128 END) * (0.7 + 0.6 * intensity / 255.0))) AS INTEGER) AS red FROM points")
def point_colours(p: DataFrame) -> DataFrame:
    base = F.when(F.col("classification") == 2, 139).when(F.col("classification") == 6, 255).otherwise(128)
    return p.select(KEY, "ok", "pk", "classification", F.least(F.lit(255), F.round(base * (0.7 + 0.6 * F.col("intensity") / 255.0)).cast("int")).alias("red"))
