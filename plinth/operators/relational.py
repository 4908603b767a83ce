"""Relational operators of the loading stage: regions, extents, labels, dedupe, profiles, resumption."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..config import LABEL_SOURCES
from ..tables import durable
from .quantiles import aggregated

#: Sides are broadcast below this many rows, checked before; beyond it a grid join takes over.
SMALL_ROWS = 10_000


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def source_pivot(labels: DataFrame, sources: Mapping[str, str] = LABEL_SOURCES) -> DataFrame:
    """PF-07: a value goes to the column of its source (named in sources); council values are split by method.  Null heights are left out."""
    src, h = F.col("dataset"), F.col("floor_height_m")
    council = src == sources["council"]
    return labels.where(h.isNotNull()).withColumns(
        {
            "survey_floor_height_m": F.when(src == sources["survey"], h),
            "nexis_floor_height_m": F.when(src == sources["nexis"], h),
            "council_surveyed_floor_height_m": F.when(council & (F.col("method") == "Surveyed"), h),
            "council_step_floor_height_m": F.when(council & (F.col("method") == "Step counting"), h),
        }
    )


def label_summary(labels: DataFrame) -> DataFrame:
    """AG-02/03: rows, rows with a height and distinct buildings of each source and method."""
    return labels.groupBy("dataset", "method").agg(F.count("*").alias("n"), F.count("floor_height_m").alias("with_height"), F.countDistinct("building_id").alias("buildings"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WN-02..04: one row a key, by a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def numbered(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """WN-01: numbers from 1 in a global order, without one task holding all rows.

    Rows are range-partitioned and sorted; a partition's first number is the count of those before it, of which
    there is one value a partition.
    """
    spark = df.sparkSession
    parts = df.repartitionByRange(*(F.col(c).asc_nulls_last() for c in order)).sortWithinPartitions(*(F.col(c).asc_nulls_last() for c in order))
    # written, so that rows with equal keys keep their numbers when a task is repeated
    parts = durable(parts.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()), "numbered")
    counts = sorted((r["__p"], r["n"]) for r in parts.groupBy("__p").agg(F.count("*").alias("n")).collect())
    total, starts = 0, []
    for p, n in counts:
        starts.append((p, total))
        total += n
    base = F.broadcast(spark.createDataFrame(starts or [(0, 0)], "__p int, __base long"))
    within = F.col("__i") - F.shiftleft(F.col("__p").cast("long"), 33) + 1
    return parts.join(base, "__p").withColumn(name, F.col("__base") + within).drop("__p", "__i", "__base")


def assign_region(buildings: DataFrame, regions: DataFrame) -> DataFrame:
    """JN-01..03: region_id of the box that holds (cx, cy), border excluded, else of the nearest box centre; ties to the least id.

    Regions are a declared list, one row each, and are broadcast after a check of their number.
    """
    if not is_small(regions):
        raise ValueError("more regions than a broadcast may hold")
    r = F.broadcast(regions.select(F.col("region_id").alias("rid"), "x0", "y0", "x1", "y1"))
    best = F.array_min(F.transform("__all", lambda b: F.struct((~_holds(b)).cast("int").alias("o"), F.when(_holds(b), 0.0).otherwise(_away(b)).alias("d"), b["rid"].alias("rid"))))
    boxes = F.broadcast(r.agg(F.collect_list(F.struct("rid", "x0", "y0", "x1", "y1")).alias("__all")))  # of a declared list
    return buildings.join(boxes).withColumn("__b", best).withColumns({"region_id": F.col("__b.rid"), "inside": F.col("__b.o") == 0}).drop("__all", "__b")


def _holds(b: Column) -> Column:
    return (F.col("cx") > b["x0"]) & (F.col("cx") < b["x1"]) & (F.col("cy") > b["y0"]) & (F.col("cy") < b["y1"])


def _away(b: Column) -> Column:
    return F.hypot(F.col("cx") - (b["x0"] + b["x1"]) / 2, F.col("cy") - (b["y0"] + b["y1"]) / 2)


def in_extent(boxes: DataFrame, tiles: DataFrame, cell: float) -> DataFrame:
    """JN-04: boxes (id, region_id, x0..y1) that meet a tile of their region (rid, rx0..ry1): some tile of a union is met iff the union is.

    Regions are few, so the join is on the region and the grid cells that both sides cover, never on the region alone.
    """
    from .spatial import cells_over

    spread = lambda df, i, x0, x1: df.withColumn(i, F.explode(cells_over(F.col(x0), F.col(x1), cell)))
    a = spread(spread(boxes, "__i", "x0", "x1"), "__j", "y0", "y1")
    b = spread(spread(tiles, "__a", "rx0", "rx1"), "__b", "ry0", "ry1")
    meet = (F.col("x0") <= F.col("rx1")) & (F.col("rx0") <= F.col("x1")) & (F.col("y0") <= F.col("ry1")) & (F.col("ry0") <= F.col("y1"))
    on = (F.col("region_id") == F.col("rid")) & (F.col("__i") == F.col("__a")) & (F.col("__j") == F.col("__b")) & meet
    return a.join(b, on, "left_semi").select("id").distinct()


def distinct_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """i, distinct: how many values other than null each column has, by its place.

    Cells become rows (column, 128-bit hash) that are made distinct map-side, so at most the distinct values are shuffled.
    """
    cells = F.inline(F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").isNotNull().alias("there"), F.xxhash64(F.col(f"`{c}`")).alias("h1"), F.xxhash64(F.lit(7), F.col(f"`{c}`")).alias("h2")) for i, c in enumerate(columns))))
    return df.select(cells).where("there").select("i", "h1", "h2").distinct().groupBy("i").agg(F.count("*").alias("distinct"))


def profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """AG-06..08: one row a column: rows, nulls, null share, distinct values, least and greatest as text."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        shown = F.lit(None) if kinds[c] == "boolean" else col
        aggs += [F.count(col).alias(f"f{i}"), F.min(shown).cast("string").alias(f"a{i}"), F.max(shown).cast("string").alias(f"z{i}")]
    wide = df.agg(*aggs)
    each = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind"), F.col(f"f{i}").alias("filled"), F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("greatest")) for i, c in enumerate(columns)))
    long = wide.select("rows", F.explode(each).alias("c")).select("rows", "c.*")
    long = long.join(F.broadcast(distinct_counts(df, columns)), "i", "left").na.fill(0, ["distinct"])  # a row a column
    share = F.when(F.col("rows") > 0, (F.col("rows") - F.col("filled")) * 100.0 / F.col("rows")).otherwise(0.0)
    flag = F.when((F.col("rows") > 0) & (F.col("filled") == 0), "ALL NULL").when(share > 95, "MOSTLY NULL").otherwise("")
    return long.select("column", "kind", "rows", (F.col("rows") - F.col("filled")).alias("nulls"), F.round(share, 4).alias("null_share"), "distinct", "least", "greatest", flag.alias("flag"))


def distinct_values(df: DataFrame, column: str, most: int = 15) -> DataFrame:
    """AG-07: the sorted values of a column that has few of them, else none."""
    found = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct().orderBy("v").limit(most + 1)
    all_ = found.agg(F.array_sort(F.collect_list("v")).alias("values"))
    return all_.select(F.lit(column).alias("column"), F.when(F.size("values") <= most, F.array_join("values", ",")).alias("values"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AG-09."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def unpivot_heights(df: DataFrame, keys: Sequence[str], methods: Sequence[str], truth: str) -> DataFrame:
    """FH-06, SF-28: a row for each method that has an estimate, with its errors."""
    long = df.unpivot([*keys, truth], list(methods), "ffh_method", "predicted_ffh").where("predicted_ffh IS NOT NULL")
    error = F.col("predicted_ffh") - F.col(truth)
    return long.select(*keys, "ffh_method", "predicted_ffh", F.col(truth).alias("ground_truth_ffh"), error.alias("error"), F.abs(error).alias("absolute_error"), (error * error).alias("squared_error"))


def error_metrics(df: DataFrame, *by: str) -> DataFrame:
    """AG-24: for each method, and each method and group of by (null: all), n and the usual measures of error."""
    e = F.col("error")
    aggs = [
        F.count("*").alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e).alias("me"),
        F.when(F.count("*") > 1, F.corr("predicted_ffh", "ground_truth_ffh")).alias("r"),
        F.stddev_pop(e).alias("std"),
    ]
    out = None
    for n in range(len(by), -1, -1):
        groups = ["ffh_method", *by[:n]]
        told = aggregated(df.where("ffh_method IS NOT NULL"), groups, aggs, {"p95": ("abs(error)", 0.95, None)})
        told = told.select(*groups, *(F.lit(None).cast(df.schema[c].dataType).alias(c) for c in by[n:]), *(c for c in told.columns if c not in groups))
        out = told if out is None else out.unionByName(told)
    return out
