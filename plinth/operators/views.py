"""Detections, view scores and the best view of each building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..config import CLASSES, HEIGHTS, SCORING
from ..functions.vector import clamp01, contrast, cosine

VIEW = ("id", "pano_id", "edge_idx", "view_type")


def confident(detections: DataFrame, least: float = 0.5, names: Sequence[str] | None = None) -> DataFrame:
    """PF-12: unknown class names are dropped; if none is known no row is left."""
    out = detections.where(F.col("confidence") >= least)
    return out.where(F.col("class_name").isin(*[n for n in names if n in CLASSES] or [""])) if names is not None else out


def class_statistics(detections: DataFrame) -> DataFrame:
    """AG-11."""
    return detections.groupBy("class_name").agg(
        F.count("*").alias("n"),
        F.countDistinct(*VIEW).alias("clips"),
        F.countDistinct("id").alias("buildings"),
        F.avg("confidence").alias("mean_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
        F.avg((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("mean_area"),
    )


def per_clip(detections: DataFrame) -> DataFrame:
    """AG-12: clips, share with a building entrance, and detections a clip of each class, in one row a class."""
    clips = detections.groupBy(*VIEW).agg(*(F.count_if(F.col("class_name") == c).alias(f"c{i}") for i, c in enumerate(CLASSES)))
    wide = clips.agg(F.count("*").alias("clips"), *(F.avg(f"c{i}").alias(f"m{i}") for i in range(len(CLASSES))), *(F.avg((F.col(f"c{i}") > 0).cast("int")).alias(f"s{i}") for i in range(len(CLASSES))))
    each = F.array(*(F.struct(F.lit(c).alias("class_name"), F.col(f"m{i}").alias("per_clip"), F.col(f"s{i}").alias("share")) for i, c in enumerate(CLASSES)))
    return wide.select("clips", F.explode(each).alias("e")).select("clips", "e.*")


def top_per_class(detections: DataFrame, n: int, tie: str = "event_id") -> DataFrame:
    """WN-08.  The limit is the feature."""
    w = Window.partitionBy("class_name").orderBy(F.col("confidence").desc(), F.col(tie))
    return detections.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def detection_scores(detections: DataFrame) -> DataFrame:
    """AG-13: of each view the greatest confidence of each class (0 if none), boxes without windows, weighted total."""
    best = {n.split()[0].lower() if n != "Front Door" else "door": n for n in CLASSES}
    aggs = [F.coalesce(F.max(F.when(F.col("class_name") == c, F.col("confidence"))), F.lit(0.0)).alias(k) for k, c in best.items()]
    out = detections.where(F.col("id").isNotNull()).groupBy(*VIEW).agg(*aggs, F.count_if(F.col("class_name") != "Window").alias("tot_boxes"))
    return out.withColumn("total_score", 1.5 * F.col("door") + F.col("stairs") + 0.75 * F.col("foundation") + 0.5 * F.col("garage"))


def door_variance(scores: DataFrame) -> DataFrame:
    """AG-14: population variance of door confidence over a building's views (1 for a single view), and its weight."""
    out = scores.groupBy("id").agg(F.count("*").alias("views"), F.when(F.count("*") > 1, F.var_pop("door")).otherwise(1.0).alias("variance"))
    return out.withColumn("weight", F.when(F.col("variance") < SCORING.low_variance, SCORING.weight_low).otherwise(SCORING.weight_high))


def combined(scores: DataFrame, similarity: Column, ground: Column, focus: Column, distance: Column) -> DataFrame:
    """SF-19: the enhanced score, and the flags that go with it."""
    t = SCORING.door_override
    on_ground = (F.col("foundation") > t) | (F.col("stairs") > t)
    entrance = (F.col("door") > t) | (F.col("garage") > t)
    bonus = F.when(on_ground & entrance, SCORING.diversity).otherwise(1.0)
    direct = F.col("view_type") == "direct"
    quality = 0.7 * (1.0 - F.least(distance / SCORING.distance_m, F.lit(1.0))) + F.when(direct, 0.3).otherwise(0.15)
    score = (
        SCORING.detection * F.col("total_score")
        + SCORING.similarity * clamp01(similarity + 0.5)
        + SCORING.ground * clamp01(F.greatest(ground, F.lit(0.0)) + 0.5)
        + SCORING.focus * clamp01(focus + 0.5)
        + SCORING.view * quality
        + bonus
        - penalty()
    )
    return scores.withColumns({"has_ground_feature": on_ground, "has_entrance_feature": entrance, "diversity_bonus": bonus, "has_door_override": F.col("door") >= t, "combined_score": score})


def penalty() -> Column:
    return F.when((F.col("tot_boxes") < 3) & (F.col("door") < SCORING.door_override), 1.0).otherwise(0.0)


def combined_basic(scores: DataFrame, similarity: Column) -> DataFrame:
    """SF-20."""
    angle = F.when(F.col("view_type") == "direct", SCORING.direct_bonus).when(F.col("view_type").isin("oblique_left", "oblique_right"), SCORING.oblique_bonus).otherwise(0.0)
    return scores.withColumn("combined_score", 0.6 * F.col("total_score") + 0.4 * clamp01(similarity + 0.5) + angle - penalty())


def best_view(scored: DataFrame) -> DataFrame:
    """WN-06: the only view with a sure door wins, else the best score, then the nearest, then the first by name."""
    building = Window.partitionBy("id")
    sole = (F.count_if("has_door_override").over(building) == 1) & F.col("has_door_override")
    order = building.orderBy(F.col("__sole").desc(), F.col("combined_score").desc(), F.col("distance"), "pano_id", "edge_idx", "view_type")
    return scored.withColumn("__sole", sole).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "__sole").withColumn("selection_type", F.lit("best"))


def closest_direct(scored: DataFrame) -> DataFrame:
    """WN-07."""
    w = Window.partitionBy("id").orderBy("distance", "pano_id", "edge_idx")
    return scored.where("view_type = 'direct'").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n").withColumn("selection_type", F.lit("closest_direct"))


def with_distance(scores: DataFrame, distances: DataFrame) -> DataFrame:
    """JN-11: distance of the view, infinite if it is not known."""
    return scores.join(distances.select(*VIEW, "distance"), list(VIEW), "left").withColumn("distance", F.coalesce("distance", F.lit(float("inf"))))


def box_metrics(detections: DataFrame, width: int, height: int, grow: float = 0.25) -> DataFrame:
    """SF-21/22/31, PF-16: size, area, centre, middle row and column, and the box grown on each side within the image."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    inside = lambda v, most: F.greatest(F.lit(0.0), F.least(v, F.lit(float(most))))
    return detections.withColumns(
        {
            "width": w,
            "height": h,
            "area": w * h,
            "center_x": (F.col("x1") + F.col("x2")) / 2,
            "center_y": (F.col("y1") + F.col("y2")) / 2,
            "mid_col": F.floor((F.col("x1") + F.col("x2")) / 2).cast("int"),
            "mid_row": F.floor((F.col("y1") + F.col("y2")) / 2).cast("int"),
            "clamped_x2": F.least(F.greatest(F.col("x2"), F.lit(0.0)), F.lit(width - 1.0)),
            "grown_x1": inside(F.col("x1") - grow * w, width),
            "grown_y1": inside(F.col("y1") - grow * h, height),
            "grown_x2": inside(F.col("x2") + grow * w, width),
            "grown_y2": inside(F.col("y2") + grow * h, height),
        }
    )


def prompt_scores(images: DataFrame, prompts: DataFrame) -> DataFrame:
    """SF-17/18, ML-03..05: mean similarity of an image to each group of prompts, and clear against blocked.

    prompts (group_name, embedding) is a declared list of a few dozen rows and is broadcast.
    """
    pairs = images.join(F.broadcast(prompts.select("group_name", F.col("embedding").alias("__p"))))
    means = pairs.select("vec_id", "group_name", cosine(F.col("embedding"), F.col("__p")).alias("s"))
    mean = lambda g: F.avg(F.when(F.col("group_name") == g, F.col("s")))
    out = means.groupBy("vec_id").agg(*(mean(g).alias(g) for g in ("clear", "blocked", "ground_clear", "ground_blocked")))
    return out.withColumns({"siglip_score": contrast(F.col("clear"), F.col("blocked")), "ground_visibility": contrast(F.col("ground_clear"), F.col("ground_blocked"))})


def coco_by_image(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """JN-23, SF-33: annotations of each image as JSON, in order of their ids; images without any have none."""
    item = F.struct("annotation_id", "category", "x1", "y1", "x2", "y2")
    held = annotations.groupBy("image_id").agg(F.count("*").alias("n"), F.to_json(F.array_sort(F.collect_list(item))).alias("annotations"))  # of one image
    return images.join(held, "image_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def yolo_lines(boxes: DataFrame, width: Column, height: Column) -> DataFrame:
    """SF-23, SK-15: class index and normalised centre and size, as a line of a label file."""
    cx, cy = (F.col("x1") + F.col("x2")) / 2 / width, (F.col("y1") + F.col("y2")) / 2 / height
    w, h = (F.col("x2") - F.col("x1")) / width, (F.col("y2") - F.col("y1")) / height
    parts = [F.format_string("%.6f", v) for v in (cx, cy, w, h)]
    index = F.array_position(F.array(*(F.lit(c) for c in CLASSES)), F.col("class_name")) - 1
    return boxes.withColumns({"class_id": index.cast("int"), "line": F.concat_ws(" ", index.cast("string"), *parts)})


def best_feature(features: DataFrame, width: Column, height: Column) -> DataFrame:
    """FH-01: of each building and class the feature of least distance from a door's usual size and place.

    Confidence is added to what is minimised, as in the method this follows.
    """
    size = F.abs(F.col("area") - HEIGHTS.area_m2) / HEIGHTS.area_m2 + F.abs(F.col("ratio") - HEIGHTS.ratio) / HEIGHTS.ratio
    place = F.when(F.col("class_name") == "Front Door", F.abs(width - (F.col("x2") - F.col("x1")) / 2) / width).otherwise(F.col("y2") / height)
    w = Window.partitionBy("id", "class_name").orderBy("feature_score", "event_id")
    out = features.withColumn("feature_score", size + F.col("confidence") + place)
    return out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def floor_heights(features: DataFrame, ground: DataFrame) -> DataFrame:
    """FH-02..05: ffh1..3 of each building; features has one row a class with top and bottom, ground has ground_elevation_m and nearest_ground_m.

    Each estimate is null by itself where a part is missing or it lies outside the allowed range; buildings without
    any estimate are left out.
    """
    is_ = lambda c: F.col("class_name") == c
    of = lambda c, v: F.max(F.when(is_(c), F.nanvl(v, F.lit(None))))
    parts = features.groupBy("id").agg(
        F.max(is_("Front Door")).alias("has_door"),
        *(of(c, F.col(v)).alias(f"{c.split()[0].lower()}_{v}") for c in CLASSES[:4] for v in ("top", "bottom")),
    )
    floor_ = F.when(F.col("has_door"), F.col("front_bottom")).when(F.col("stairs_bottom").isNotNull(), F.col("stairs_top")).otherwise(F.when(F.col("foundation_bottom").isNotNull(), F.col("foundation_top")))
    below = F.coalesce("garage_bottom", "stairs_bottom", "foundation_bottom")
    known = parts.join(ground, "id", "left").withColumns({"floor": floor_, "feature_ground": below})
    within = lambda v: F.when((v >= HEIGHTS.least) & (v <= HEIGHTS.most), v)
    out = known.select(
        "id",
        within(F.col("floor") - F.col("feature_ground")).alias("ffh1"),
        within(F.col("floor") - F.col("nearest_ground_m")).alias("ffh2"),
        within(F.col("floor") - F.col("ground_elevation_m")).alias("ffh3"),
        F.lit("feature_detection").alias("method"),
    )
    return out.where("ffh1 IS NOT NULL OR ffh2 IS NOT NULL OR ffh3 IS NOT NULL")
