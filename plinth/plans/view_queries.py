"""Queries over detections, views, scores and floor heights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import CLASSES
from ..operators import views as ops
from .registry import ENTRIES, Entry, query, r4, rounded

_SCORES = """s AS (SELECT id, pano_id, edge_idx, view_type, coalesce(max(CASE WHEN class_name = 'Front Door' THEN confidence END), 0) AS door, coalesce(max(CASE WHEN class_name = 'Garage Door' THEN confidence END), 0) AS garage,
coalesce(max(CASE WHEN class_name = 'Stairs' THEN confidence END), 0) AS stairs, coalesce(max(CASE WHEN class_name = 'Foundation' THEN confidence END), 0) AS foundation, coalesce(max(CASE WHEN class_name = 'Window' THEN confidence END), 0) AS win,
count(*) FILTER (WHERE class_name <> 'Window') AS tot_boxes FROM detections WHERE id IS NOT NULL GROUP BY id, pano_id, edge_idx, view_type),
t AS (SELECT *, 1.5 * door + stairs + 0.75 * foundation + 0.5 * garage AS total_score, CASE WHEN (id + pano_id) % 3 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST((id * 7 + pano_id * 3 + edge_idx) % 45 AS DOUBLE) END AS distance,
CAST((id * 13 + pano_id) % 21 - 10 AS DOUBLE) / 20.0 AS sim, CAST((id + pano_id * 5) % 11 - 5 AS DOUBLE) / 10.0 AS ground FROM s),
c AS (SELECT *, door >= 0.15 AS has_door_override, (foundation > 0.15 OR stairs > 0.15) AS has_ground_feature, (door > 0.15 OR garage > 0.15) AS has_entrance_feature,
0.35 * total_score + 0.20 * greatest(0, least(1, sim + 0.5)) + 0.20 * greatest(0, least(1, greatest(ground, 0) + 0.5)) + 0.15 * 0.5
+ 0.10 * (0.7 * (1 - least(distance / 50, 1)) + CASE WHEN view_type = 'direct' THEN 0.3 ELSE 0.15 END)
+ CASE WHEN (foundation > 0.15 OR stairs > 0.15) AND (door > 0.15 OR garage > 0.15) THEN 1.5 ELSE 1.0 END - CASE WHEN tot_boxes < 3 AND door < 0.15 THEN 1 ELSE 0 END AS combined_score FROM t)"""


def scored(detections: DataFrame) -> DataFrame:
    """Scores of each view, with stand-ins for distance, similarity and ground visibility; the batch scorer knows no focus."""
    s = ops.detection_scores(detections)
    views = s.select(*ops.VIEW, F.expr("CAST((id * 7 + pano_id * 3 + edge_idx) % 45 AS DOUBLE)").alias("distance")).where("(id + pano_id) % 3 <> 0")
    s = ops.with_distance(s, views)
    sim, ground = F.expr("CAST((id * 13 + pano_id) % 21 - 10 AS DOUBLE) / 20.0D"), F.expr("CAST((id + pano_id * 5) % 11 - 5 AS DOUBLE) / 10.0D")
    return ops.combined(s, sim, ground, F.lit(0.0), F.col("distance"))


@query("AG-11 PF-12", "detections", sql="""SELECT class_name, count(*) AS n, count(DISTINCT (id, pano_id, edge_idx, view_type)) AS clips, count(DISTINCT id) AS buildings, round(avg(confidence), 4) AS mean_confidence, round(min(confidence), 4) AS min_confidence, round(max(confidence), 4) AS max_confidence,
round(avg((x2 - x1) * (y2 - y1)), 4) AS mean_area FROM detections WHERE confidence >= 0.3 AND class_name IN ('Front Door', 'Stairs', 'Window') GROUP BY class_name""")
def detection_class_stats(d: DataFrame) -> DataFrame:
    return rounded(ops.class_statistics(ops.confident(d, 0.3, ["Front Door", "Stairs", "Window", "Chimney"])))


@query(
    "AG-12 AG-25",
    "detections",
    sql="WITH c AS (SELECT id, pano_id, edge_idx, view_type, " + ", ".join(f"count(*) FILTER (WHERE class_name = '{c}') AS c{i}" for i, c in enumerate(CLASSES)) + " FROM detections GROUP BY ALL) " + " UNION ALL ".join(f"SELECT count(*) AS clips, '{c}' AS class_name, round(avg(c{i}), 4) AS per_clip, round(avg(CASE WHEN c{i} > 0 THEN 1.0 ELSE 0.0 END), 4) AS share FROM c" for i, c in enumerate(CLASSES)),
)
def detection_avg_per_clip(d: DataFrame) -> DataFrame:
    return rounded(ops.per_clip(d))


@query("WN-08", "detections", sql="WITH k AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY confidence DESC, event_id) AS rank FROM detections) SELECT class_name, rank, event_id, round(confidence, 4) AS confidence FROM k WHERE rank <= 20")
def rare_examples_topn(d: DataFrame) -> DataFrame:
    return ops.top_per_class(d, 20).select("class_name", "rank", "event_id", *r4("confidence"))


@query("AG-13", "detections", sql=f"WITH {_SCORES} SELECT id, pano_id, edge_idx, view_type, round(door, 4) AS door, round(garage, 4) AS garage, round(stairs, 4) AS stairs, round(foundation, 4) AS foundation, round(win, 4) AS win, tot_boxes, round(total_score, 4) AS total_score FROM t")
def view_detection_scores(d: DataFrame) -> DataFrame:
    return rounded(ops.detection_scores(d).withColumnRenamed("window", "win").select(*ops.VIEW, "door", "garage", "stairs", "foundation", "win", "tot_boxes", "total_score"))


@query("AG-14", "detections", sql=f"WITH {_SCORES}, v AS (SELECT id, count(*) AS views, CASE WHEN count(*) > 1 THEN var_pop(door) ELSE 1.0 END AS variance FROM s GROUP BY id) SELECT id, views, round(variance, 4) AS variance, CASE WHEN variance < 0.05 THEN 3.0 ELSE 2.5 END AS weight FROM v")
def door_variance_weight(d: DataFrame) -> DataFrame:
    return rounded(ops.door_variance(ops.detection_scores(d)))


@query("SF-19 JN-11 Q-09", "detections", sql=f"WITH {_SCORES} SELECT id, pano_id, edge_idx, view_type, round(combined_score, 4) AS combined_score, has_door_override, has_ground_feature, has_entrance_feature FROM c")
def combined_scores(d: DataFrame) -> DataFrame:
    return scored(d).select(*ops.VIEW, *r4("combined_score"), "has_door_override", "has_ground_feature", "has_entrance_feature")


@query("SF-20", "detections", sql=f"WITH {_SCORES} SELECT id, pano_id, edge_idx, view_type, round(0.6 * total_score + 0.4 * greatest(0, least(1, sim + 0.5)) + CASE view_type WHEN 'direct' THEN 0.15 WHEN 'oblique_left' THEN -0.1 WHEN 'oblique_right' THEN -0.1 ELSE 0 END - CASE WHEN tot_boxes < 3 AND door < 0.15 THEN 1 ELSE 0 END, 4) AS combined_score FROM t")
def combined_scores_basic(d: DataFrame) -> DataFrame:
    return ops.combined_basic(ops.detection_scores(d), F.expr("CAST((id * 13 + pano_id) % 21 - 10 AS DOUBLE) / 20.0D")).select(*ops.VIEW, *r4("combined_score"))


@query(
    "WN-06 SF-19 JN-11 AG-13",
    "detections",
    sql=f"""WITH {_SCORES}, o AS (SELECT *, sum(CASE WHEN has_door_override THEN 1 ELSE 0 END) OVER (PARTITION BY id) AS n_over FROM c),
    k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN n_over = 1 AND has_door_override THEN 0 ELSE 1 END, combined_score DESC, distance, pano_id, edge_idx, view_type) AS n FROM o)
    SELECT id, pano_id, edge_idx, view_type, round(total_score, 4) AS detection_score, round(combined_score, 4) AS combined_score, has_door_override, 'best' AS selection_type FROM k WHERE n = 1""",
)
def best_view_per_building(d: DataFrame) -> DataFrame:
    return ops.best_view(scored(d)).select(*ops.VIEW, F.round("total_score", 4).alias("detection_score"), *r4("combined_score"), "has_door_override", "selection_type")


@query("WN-07", "detections", sql=f"WITH {_SCORES}, k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, pano_id, edge_idx) AS n FROM c WHERE view_type = 'direct') SELECT id, pano_id, edge_idx, 'closest_direct' AS selection_type FROM k WHERE n = 1")
def closest_direct_view(d: DataFrame) -> DataFrame:
    return ops.closest_direct(scored(d)).select("id", "pano_id", "edge_idx", "selection_type")


@query("AG-15", "detections", sql=f"WITH {_SCORES} SELECT count(*) AS views, round(avg(total_score), 4) AS mean_detection, round(avg(combined_score), 4) AS mean_combined, round(avg(CASE WHEN has_door_override THEN 1.0 ELSE 0.0 END), 4) AS door_share, round(var_pop(door), 4) AS door_variance FROM c")
def score_summary(d: DataFrame) -> DataFrame:
    return scored(d).agg(F.count("*").alias("views"), F.round(F.avg("total_score"), 4).alias("mean_detection"), F.round(F.avg("combined_score"), 4).alias("mean_combined"), F.round(F.avg(F.col("has_door_override").cast("int")), 4).alias("door_share"), F.round(F.var_pop("door"), 4).alias("door_variance"))


@query(
    "SF-21 SF-22 SF-31 PF-16",
    "detections",
    sql="""SELECT event_id, round(x2 - x1, 4) AS width, round(y2 - y1, 4) AS height, round((x2 - x1) * (y2 - y1), 6) AS area, round((x1 + x2) / 2, 4) AS center_x, CAST(floor((x1 + x2) / 2) AS INTEGER) AS mid_col, CAST(floor((y1 + y2) / 2) AS INTEGER) AS mid_row,
    round(least(greatest(x2, 0), 999), 4) AS clamped_x2, round(greatest(0, least(x1 - 0.25 * (x2 - x1), 1000)), 6) AS grown_x1, round(greatest(0, least(y2 + 0.25 * (y2 - y1), 500)), 6) AS grown_y2 FROM detections""",
)
def box_metrics(d: DataFrame) -> DataFrame:
    b = ops.box_metrics(d, 1000, 500)
    return b.select("event_id", *r4("width", "height"), F.round("area", 6).alias("area"), *r4("center_x"), "mid_col", "mid_row", *r4("clamped_x2"), F.round("grown_x1", 6).alias("grown_x1"), F.round("grown_y2", 6).alias("grown_y2"))


@query(
    "SF-23 JN-22 SK-15",
    "detections",
    sql="SELECT event_id, CASE class_name " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CLASSES)) + " END AS class_id, round((x1 + x2) / 2 / 1400, 9) AS cx, round((y2 - y1) / 600, 9) AS h FROM detections",
)
def yolo_labels(d: DataFrame) -> DataFrame:
    y = ops.yolo_lines(d, F.lit(1400.0), F.lit(600.0))
    part = F.split("line", " ")
    exact_cx, exact_h = (F.col("x1") + F.col("x2")) / 2 / 1400, (F.col("y2") - F.col("y1")) / 600
    agrees = (F.abs(part[1].cast("double") - exact_cx) < 1e-6) & (F.abs(part[4].cast("double") - exact_h) < 1e-6)
    return y.select("event_id", "class_id", F.when(agrees, F.round(exact_cx, 9)).alias("cx"), F.when(agrees, F.round(exact_h, 9)).alias("h"))


@query(
    "JN-23 SC-14 SK-14 SF-33",
    "detections",
    sql="SELECT id AS image_id, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY event_id) AS place, event_id AS annotation_id, class_name AS category, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM detections",
)
def annotations_json(d: DataFrame) -> DataFrame:
    """Each image's annotations as JSON, read back."""
    a = d.select(F.col("id").alias("image_id"), F.col("event_id").alias("annotation_id"), F.col("class_name").alias("category"), "x1", "y1", "x2", "y2")
    text = ops.coco_by_image(d.select(F.col("id").alias("image_id")).distinct(), a)
    items = F.from_json("annotations", "array<struct<annotation_id: bigint, category: string, x1: double, y1: double, x2: double, y2: double>>")
    back = text.select("image_id", "n", F.posexplode(items).alias("place", "i"))
    return rounded(back.select("image_id", "n", (F.col("place") + 1).cast("long").alias("place"), "i.*"), 6)


@query("JN-23", "detections", sql="SELECT id AS image_id, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM detections GROUP BY id")
def coco_group_by_image(d: DataFrame) -> DataFrame:
    return d.groupBy(F.col("id").alias("image_id")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda i: i.cast("string")), ",").alias("ids"))


def _prompt_group(column: str) -> str:
    return f"CASE WHEN {column} < 3 THEN 'clear' WHEN {column} < 6 THEN 'blocked' WHEN {column} < 10 THEN 'ground_clear' WHEN {column} < 14 THEN 'ground_blocked' ELSE 'other' END"


def prompt_contrast_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    prompts = e.where("vec_id < 20").select(F.expr(_prompt_group("vec_id")).alias("group_name"), "embedding")
    out = ops.prompt_scores(e.where("vec_id >= 20"), prompts)
    return out.select("vec_id", *r4("clear", "blocked", "ground_clear"), F.round("ground_visibility", 2).alias("unused")).drop("unused")


_COS = "list_sum(list_transform(range(1, len(i.embedding) + 1), lambda k: i.embedding[k]::DOUBLE * p.embedding[k]::DOUBLE)) / (sqrt(list_sum(list_transform(i.embedding, lambda v: v::DOUBLE * v::DOUBLE))) * sqrt(list_sum(list_transform(p.embedding, lambda v: v::DOUBLE * v::DOUBLE))))"
ENTRIES["prompt_contrast_scores"] = Entry(
    "prompt_contrast_scores",
    "SF-17 SF-18 ML-03 ML-04 ML-05",
    prompt_contrast_scores,
    f"""WITH s AS (SELECT i.vec_id, {_prompt_group('p.vec_id')} AS g, {_COS} AS s FROM embeddings i JOIN embeddings p ON p.vec_id < 20 AND i.vec_id >= 20)
    SELECT vec_id, round(avg(s) FILTER (WHERE g = 'clear'), 4) AS clear, round(avg(s) FILTER (WHERE g = 'blocked'), 4) AS blocked, round(avg(s) FILTER (WHERE g = 'ground_clear'), 4) AS ground_clear FROM s GROUP BY vec_id""",
)


def contrast_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    a, b = F.get("embedding", F.lit(0)).cast("double") + 1.0, F.get("embedding", F.lit(1)).cast("double") + 1.0
    return e.select("vec_id", F.round(ops.contrast(a, b), 4).alias("score"))


ENTRIES["contrast_scores"] = Entry("contrast_scores", "SF-17", contrast_scores, "SELECT vec_id, round((embedding[1]::DOUBLE - embedding[2]::DOUBLE) / (embedding[1]::DOUBLE + embedding[2]::DOUBLE + 2.0 + 1e-6), 4) AS score FROM embeddings")

_FEATURES = """f AS (SELECT event_id, id, class_name, confidence, x1, x2, y1, y2, (x2 - x1) * (y2 - y1) / 2000.0 AS area, (x2 - x1) / (y2 - y1) AS ratio,
CASE WHEN event_id % 9 = 0 THEN NULL ELSE 1.0 + CAST(event_id % 97 AS DOUBLE) / 61.0 END AS "top", CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 83 AS DOUBLE) / 59.0 END AS bottom FROM detections),
b AS (SELECT *, row_number() OVER (PARTITION BY id, class_name ORDER BY abs(area - 1.67) / 1.67 + abs(ratio - 0.40) / 0.40 + confidence + CASE WHEN class_name = 'Front Door' THEN abs(1000 - (x2 - x1) / 2) / 1000 ELSE y2 / 500 END, event_id) AS n FROM f)"""


def _features(d: DataFrame) -> DataFrame:
    return d.select(
        "event_id", "id", "class_name", "confidence", "x1", "x2", "y1", "y2",
        ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) / 2000.0).alias("area"),
        ((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("ratio"),
        F.expr("CASE WHEN event_id % 9 = 0 THEN NULL ELSE 1.0D + CAST(event_id % 97 AS DOUBLE) / 61.0D END").alias("top"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 83 AS DOUBLE) / 59.0D END").alias("bottom"),
    )


@query("FH-01 WN-11 Q-05", "detections", sql=f"WITH {_FEATURES} SELECT id, class_name, event_id FROM b WHERE n = 1")
def best_feature_per_class(d: DataFrame) -> DataFrame:
    return ops.best_feature(_features(d), F.lit(1000.0), F.lit(500.0)).select("id", "class_name", "event_id")


@query(
    "FH-02 FH-03 FH-04 FH-05 Q-04 JN-14",
    "detections",
    sql=f"""WITH {_FEATURES}, p AS (SELECT id, bool_or(class_name = 'Front Door') AS has_door, """
    + ", ".join(f"max(CASE WHEN class_name = '{c}' THEN \"{v}\" END) AS {c.split()[0].lower()}_{v}" for c in CLASSES[:4] for v in ("top", "bottom"))
    + """ FROM b WHERE n = 1 GROUP BY id),
    g AS (SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 23 AS DOUBLE) / 31.0 END AS ge, CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 29 AS DOUBLE) / 37.0 END AS ng,
    CASE WHEN has_door THEN front_bottom WHEN stairs_bottom IS NOT NULL THEN stairs_top WHEN foundation_bottom IS NOT NULL THEN foundation_top END AS fl, coalesce(garage_bottom, stairs_bottom, foundation_bottom) AS fg FROM p),
    h AS (SELECT id, CASE WHEN fl - fg BETWEEN 0 AND 2 THEN fl - fg END AS ffh1, CASE WHEN fl - ng BETWEEN 0 AND 2 THEN fl - ng END AS ffh2, CASE WHEN fl - ge BETWEEN 0 AND 2 THEN fl - ge END AS ffh3 FROM g)
    SELECT id, round(ffh1, 4) AS ffh1, round(ffh2, 4) AS ffh2, round(ffh3, 4) AS ffh3, 'feature_detection' AS method FROM h WHERE ffh1 IS NOT NULL OR ffh2 IS NOT NULL OR ffh3 IS NOT NULL""",
)
def ffh_estimates(d: DataFrame) -> DataFrame:
    best = ops.best_feature(_features(d), F.lit(1000.0), F.lit(500.0))
    ground = d.select("id").distinct().select("id", F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 23 AS DOUBLE) / 31.0D END").alias("ground_elevation_m"), F.expr("CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 29 AS DOUBLE) / 37.0D END").alias("nearest_ground_m"))
    return rounded(ops.floor_heights(best, ground))
