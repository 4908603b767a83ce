"""CL-01/02, ST-04: stages by name, number or alias, run in the order given against one catalogue."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..catalog import Catalog
from ..config import CLIP, HEIGHTS, RASTER
from ..functions import geo, text
from ..operators import kernels, pointcloud, qa, relational, spatial, views

Stage = Callable[[Catalog, str | None], DataFrame]


@dataclass(frozen=True)
class Definition:
    name: str
    aliases: tuple[str, ...]
    needs: tuple[str, ...]
    run: Stage
    key: tuple[str, ...]
    #: The table that the stage adds to: the name by which later stages read it.
    writes: str


def _of(c: Catalog, name: str, region: str | None) -> DataFrame:
    """A table's rows of a region: by its own column, else by its buildings."""
    df = c.table(name)
    if region is None:
        return df
    if "region_name" in df.columns:
        return c.scan(name, region=region)
    return df.join(c.scan("buildings", ["id"], region=region), "id", "left_semi") if "id" in df.columns else df


def _footprints(c: Catalog, region: str | None) -> DataFrame:
    return c.scan("buildings", region=region).withColumn("ring", geo.ring_of(F.col("footprint_wkt")))


def _clip(c: Catalog, region: str | None) -> DataFrame:
    """Points within the mitred buffer of the simplified footprint."""
    rings = kernels.simplified(_footprints(c, region).select("id", "building_id", "region_name", "ring"), CLIP.tolerance)
    points = _of(c, "points", region).drop("region_name")
    return spatial.points_in_buffers(points, rings, 50.0, CLIP.buffer_m).drop("ring", "x0", "y0", "x1", "y1")


def _harvest(c: Catalog, region: str | None) -> DataFrame:
    b = _footprints(c, region).select("id", "ring")
    rays = spatial.candidate_views(b, _of(c, "panoramas", region))
    walls = spatial.edges_of(b).select(F.col("id").alias("bid"), "ax", "ay", "bx", "by")
    return spatial.chosen(spatial.visible(rays, walls, 40.0, ("id", "edge_idx", "pano_id"), spatial.overlapping(b, 40.0)))


def _downloads(c: Catalog, region: str | None) -> DataFrame:
    """Chosen views with the first of their possible object names that the listing (name, path) holds."""
    views_ = _of(c, "candidate_views", region).where("is_chosen").drop("region_name").join(c.scan("buildings", ["id", "region_name"], region=region), "id")
    names = text.object_names(F.col("pano_id").cast("string"), F.col("region_name"))
    asked = views_.select(*views.VIEW, F.posexplode(names).alias("turn", "name"))
    found = asked.join(c.scan("pano_files", ["name", "path"]), "name").groupBy(*views.VIEW).agg(F.min(F.struct("turn", "path")).alias("f"))
    return found.select(*views.VIEW, F.col("f.path").alias("download_path"))


def _windows(c: Catalog, region: str | None) -> DataFrame:
    """The window of each downloaded panorama that shows the building."""
    asked = _of(c, "candidate_views", region).where("is_chosen").join(_of(c, "downloads", region).select(*views.VIEW), list(views.VIEW), "left_semi")
    cameras = _of(c, "panoramas", region).select("pano_id", F.col("x").alias("cam_x"), F.col("y").alias("cam_y"), F.col("heading").alias("yaw"))
    pixels = spatial.vertex_pixels(asked.select(*views.VIEW).join(cameras, "pano_id"), _footprints(c, region), RASTER.width)
    return spatial.clip_bounds(pixels, views.VIEW, RASTER.width, RASTER.height, RASTER.upper_crop, RASTER.lower_crop)


def _best(c: Catalog, region: str | None) -> DataFrame:
    s = views.with_distance(views.detection_scores(_of(c, "detections", region)), _of(c, "candidate_views", region))
    s = s.join(_of(c, "image_scores", region).drop("region_name"), list(views.VIEW), "left").na.fill(0.0, ["siglip_score", "ground_visibility"])
    return views.best_view(views.combined(s, F.col("siglip_score"), F.col("ground_visibility"), F.lit(0.0), F.col("distance")))


def _ground(c: Catalog, region: str | None) -> DataFrame:
    return pointcloud.ground_elevation(_of(c, "clipped_points", region), "id").withColumn("method", F.lit("statistics"))


def _heights(c: Catalog, region: str | None) -> DataFrame:
    """The nearest ground of a building is what its features carry, if the projection gave any."""
    best = views.best_feature(_of(c, "features", region), F.col("image_width"), F.col("image_height"))
    ground = _of(c, "ground", region).select("id", "ground_elevation_m")
    if "nearest_ground_m" in best.columns:
        nearest = best.groupBy("id").agg(F.min("nearest_ground_m").alias("nearest_ground_m"))
        return views.floor_heights(best, ground.join(nearest, "id", "full"))
    return views.floor_heights(best, ground.withColumn("nearest_ground_m", F.lit(None).cast("double")))


def _validate(c: Catalog, region: str | None) -> DataFrame:
    heights = _of(c, "heights", region)
    found = relational.first_per_key(heights, ["id"], [F.to_json(F.struct(*sorted(heights.columns)))])  # a total order
    truth = relational.first_per_key(_of(c, "labels", region), ["id"], [F.col("floor_height_m")]).select("id", "floor_height_m")
    return relational.unpivot_heights(found.join(truth, "id"), ["id"], ["ffh1", "ffh2", "ffh3"], "floor_height_m")


def _lidar(c: Catalog, region: str | None) -> DataFrame:
    p = _of(c, "clipped_points", region)
    ring = geo.ring_of(F.col("footprint_wkt"))
    clips = c.scan("buildings", region=region).select("id", ring.alias("ring")).withColumn("footprint_area", geo.area(F.col("ring")))
    return pointcloud.full_record(p, clips.join(p.select("id").distinct(), "id", "left_semi"), "id").drop("ring")


def _qa(c: Catalog, region: str | None) -> DataFrame:
    p = _of(c, "points", region).withColumn("pid", F.concat_ws("-", "tile_id", "point_id"))
    return qa.report(p.select("tile_id").distinct(), qa.run_checks(p, "tile_id"), "tile_id", pointcloud.density_grid(p, "tile_id", 1.0))


STAGES = (
    Definition("stage01", ("1", "clip"), ("buildings", "points"), _clip, ("id", "tile_id", "point_id"), "clipped_points"),
    Definition("stage02a", ("2a", "harvest"), ("buildings", "panoramas"), _harvest, ("id", "edge_idx", "view_type", "pano_id"), "candidate_views"),
    Definition("stage02b", ("2b", "downloads"), ("candidate_views", "buildings", "pano_files"), _downloads, views.VIEW, "downloads"),
    Definition("stage03", ("3", "windows"), ("candidate_views", "downloads", "panoramas", "buildings"), _windows, views.VIEW, "windows"),
    Definition("stage04b", ("4b", "best-view"), ("detections", "candidate_views", "image_scores"), _best, ("id",), "best_views"),
    Definition("stage06", ("6", "ground"), ("clipped_points",), _ground, ("id",), "ground"),
    Definition("stage07", ("7", "ffh", "floors"), ("features", "ground"), _heights, ("id",), "heights"),
    Definition("stage08", ("8", "validate", "validation"), ("heights", "labels"), _validate, ("id", "ffh_method"), "validation"),
    Definition("stage09a", ("9a", "lidar-stats"), ("clipped_points", "buildings"), _lidar, ("id",), "lidar_stats"),
    Definition("qa", ("qa-run",), ("points",), _qa, ("tile_id",), "qa_report"),
)
assert HEIGHTS.least <= HEIGHTS.most


def resolve(names: Iterable[str]) -> list[Definition]:
    """Stages once each, in the order given; an unknown name is an error."""
    known = {n: d for d in STAGES for n in (d.name, *d.aliases)}
    return [known[n] for n in dict.fromkeys(known[n].name for n in names)]


def missing(c: Catalog, stage: Definition) -> list[str]:
    """CL-03: tables a stage needs that are not there."""
    return [t for t in stage.needs if not c.exists(t)]


def run(c: Catalog, names: Iterable[str], region: str | None = None, to: dict[str, str] | None = None, failed: dict[str, Exception] | None = None) -> dict[str, int]:
    """Rows added by each stage; the region holds in every stage, and a rerun adds nothing twice.

    Each stage writes the table that the next ones read; to names other tables by stage.

    Where failed is given, a stage that fails is put there with its error and the next ones still run.
    """
    added = {}
    for stage in resolve(names):
        try:
            if gone := missing(c, stage):
                raise FileNotFoundError(f"{stage.name} needs {', '.join(gone)}")
            added[stage.name] = c.append(stage.run(c, region), (to or {}).get(stage.name, stage.writes), stage.key)
        except Exception as e:
            if failed is None:
                raise
            failed[stage.name] = e
    return added
