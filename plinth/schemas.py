"""Declared table schemas: a common prefix, the columns of each stage, the time of processing."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

STRING, INT, LONG, FLOAT, DOUBLE, BOOLEAN = StringType(), IntegerType(), LongType(), FloatType(), DoubleType(), BooleanType()

# The columns of each stage table.
COLUMNS: dict[str, dict[str, DataType]] = {
    "stage01_clips": {
        "clip_path": STRING,
        "tile_count": INT,
    },
    "stage02a_buildings": {
        "candidate_count": INT,
        "chosen_count": INT,
    },
    "stage02a_building_geoms": {
        "geom_type": STRING,
        "view_type": STRING,
        "edge_idx": INT,
        "geom_wkt": STRING,
    },
    "stage02a_derived_geoms": {
        "geom_type": STRING,
        "view_type": STRING,
        "edge_idx": INT,
        "geom_wkt": STRING,
    },
    "stage02a_panoramas": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "distance": DOUBLE,
        "heading_diff": DOUBLE,
        "coverage_score": DOUBLE,
        "quality_score": DOUBLE,
        "capture_date": STRING,
    },
    "stage02a_candidate_views": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "distance": DOUBLE,
        "angle": DOUBLE,
        "is_chosen": BOOLEAN,
        "ray_wkt": STRING,
        "pano_lat": DOUBLE,
        "pano_lon": DOUBLE,
        "pano_heading": DOUBLE,
        "footprint_geom_mga": STRING,
    },
    "stage02b_downloads": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "download_path": STRING,
    },
    "stage03_clips": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "clip_path": STRING,
        "clip_left": FLOAT,
        "clip_right": FLOAT,
        "clip_top": FLOAT,
        "clip_bottom": FLOAT,
    },
    "stage04a_clips": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "clip_path": STRING,
        "detection_count": INT,
    },
    "stage04a_detections": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "class_id": INT,
        "class_name": STRING,
        "confidence": FLOAT,
        "bbox_x1": FLOAT,
        "bbox_y1": FLOAT,
        "bbox_x2": FLOAT,
        "bbox_y2": FLOAT,
        "bbox_width": FLOAT,
        "bbox_height": FLOAT,
        "bbox_area": FLOAT,
        "bbox_center_x": FLOAT,
        "bbox_center_y": FLOAT,
        "image_width": INT,
        "image_height": INT,
    },
    "stage04b_best_views": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "detection_score": FLOAT,
        "siglip_score": FLOAT,
        "combined_score": FLOAT,
        "distance": FLOAT,
        "siglip_weight": FLOAT,
        "has_door_override": BOOLEAN,
        "diversity_bonus": FLOAT,
        "view_angle_bonus": FLOAT,
        "has_ground_feature": BOOLEAN,
        "has_entrance_feature": BOOLEAN,
        "selection_type": STRING,
        "status": STRING,
        "error_message": STRING,
        "clip_image_path": STRING,
        "ground_visibility_score": FLOAT,
    },
    "stage05_projections": {
        "pano_id": STRING,
        "edge_idx": INT,
        "view_type": STRING,
        "projection_path": STRING,
        "point_count": INT,
        "coverage_percent": FLOAT,
    },
    "stage06_ground_elevations": {
        "ground_elevation_m": FLOAT,
        "ground_points_count": INT,
        "confidence_score": FLOAT,
        "method": STRING,
    },
    "stage07_floor_heights": {
        "ffh1": FLOAT,
        "ffh2": FLOAT,
        "ffh3": FLOAT,
        "method": STRING,
    },
    "stage08_validation": {
        "ffh_method": STRING,
        "predicted_ffh": FLOAT,
        "ground_truth_ffh": FLOAT,
        "error": FLOAT,
        "absolute_error": FLOAT,
        "squared_error": FLOAT,
    },
    "stage09a_lidar_stats": {
        "las_path": STRING,
        "point_count": INT,
        "footprint_area": FLOAT,
        "point_density": FLOAT,
        "building_height": FLOAT,
        "convex_hull_area": FLOAT,
        "coverage_ratio": FLOAT,
        "spatial_coverage": FLOAT,
        "z_min": FLOAT,
        "z_max": FLOAT,
        "z_range": FLOAT,
        "z_mean": FLOAT,
        "z_std": FLOAT,
        "z_p10": FLOAT,
        "z_p25": FLOAT,
        "z_p50": FLOAT,
        "z_p75": FLOAT,
        "z_p90": FLOAT,
        "pts_0_3m": INT,
        "pts_3_6m": INT,
        "pts_6_9m": INT,
        "pts_9_12m": INT,
        "pts_above_12m": INT,
        "returns_single": INT,
        "returns_multiple": INT,
        "intensity_mean": FLOAT,
        "intensity_std": FLOAT,
        "ground_point_count": INT,
        "ground_z_mean": FLOAT,
        "ground_z_std": FLOAT,
        "noise_point_count": INT,
        "roof_z_variance": FLOAT,
        "vegetation_proximity_count": INT,
        "verticality_score": FLOAT,
        "planarity_score": FLOAT,
        "building_height_peaks": INT,
        "building_height_regularity": FLOAT,
        "facade_alignment_score": FLOAT,
        "building_density_0_3m": FLOAT,
        "building_density_3_6m": FLOAT,
        "building_density_6_9m": FLOAT,
        "building_density_9_12m": FLOAT,
        "building_density_12_15m": FLOAT,
        "building_density_15_20m": FLOAT,
        "building_density_20_30m": FLOAT,
        "building_density_30_50m": FLOAT,
        "multi_return_ratio_0_10m": FLOAT,
        "multi_return_ratio_10_20m": FLOAT,
        "multi_return_ratio_20_30m": FLOAT,
        "multi_return_ratio_30_50m": FLOAT,
        "ground_height_variance": FLOAT,
        "ground_height_iqr": FLOAT,
        "building_height_variance": FLOAT,
        "building_height_iqr": FLOAT,
        "class_0_never": INT,
        "class_1_unassigned": INT,
        "class_2_ground": INT,
        "class_3_low_veg": INT,
        "class_4_med_veg": INT,
        "class_5_high_veg": INT,
        "class_6_building": INT,
        "class_7_noise": INT,
    },
}


def stage_schema(name: str) -> StructType:
    prefix = {"id": LONG, "building_id": STRING, "region_name": STRING, "gnaf_id": STRING}
    columns = prefix | COLUMNS[name] | {"processed_at": TimestampNTZType()}
    return StructType([StructField(c, kind) for c, kind in columns.items()])


STAGE_SCHEMAS = {name: stage_schema(name) for name in COLUMNS}
