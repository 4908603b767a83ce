"""Text sources: trajectories, annotations, region lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import REGIONS

TRAJECTORY = "imgID string, Latitude_deg double, Longitude_deg double, Heading_deg double, Pitch_deg double, Roll_deg double, LTP_z_m double"


def read_trajectory(spark: SparkSession, path: str, schema: str | None = TRAJECTORY) -> DataFrame:
    """SC-04: camera positions, with their point.  A declared schema spares a pass; None infers one."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.withColumn("geometry", F.struct(F.col("Longitude_deg").alias("x"), F.col("Latitude_deg").alias("y")))


def regions(spark: SparkSession) -> DataFrame:
    """SC-15."""
    return spark.createDataFrame([(r.id, r.name, r.crs, r.xmin, r.ymin, r.xmax, r.ymax) for r in REGIONS], "id string, name string, crs int, x0 double, y0 double, x1 double, y1 double")


def read_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SC-14, JN-22: images, and annotations with the dense index of their category in its order of ids."""
    raw = spark.read.option("multiLine", True).json(path)
    images = raw.select(F.explode("images").alias("i")).select("i.*")
    listed = raw.select(F.posexplode(F.array_sort(F.transform("categories", lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"))))).alias("class_id", "c")).select("class_id", F.col("c.id").alias("category_id"), F.col("c.name").alias("class_name"))
    boxes = raw.select(F.explode("annotations").alias("a")).select("a.*")
    out = boxes.join(F.broadcast(listed), "category_id")  # a declared list of classes
    box = lambda i: F.get("bbox", F.lit(i)).cast("double")
    return images, out.withColumns({"x1": box(0), "y1": box(1), "x2": box(0) + box(2), "y2": box(1) + box(3)})


def polygon_line(flat, width, height):
    """SF-23: a flat polygon as pairs in parts of the image; an odd last number is left out."""
    pairs = F.sequence(F.lit(0), F.floor(F.size(flat) / 2).cast("int") - 1)
    return F.transform(pairs, lambda i: F.struct((F.get(flat, 2 * i) / width).alias("x"), (F.get(flat, 2 * i + 1) / height).alias("y")))
