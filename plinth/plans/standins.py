"""Reference-shaped inputs derived from the driver's tables, the same expressions in Spark and in the oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (source table, select list).  Expressions are common to both engines.
VIEWS = {
    "points": (
        "lineitem",
        "l_suppkey AS tile_id, l_extendedprice / 1000.0 AS x, CAST(l_quantity AS DOUBLE) AS y, l_discount * 100.0 + l_tax * 10.0 AS z, "
        "CAST(l_linenumber AS INTEGER) AS classification, CAST(l_partkey % 256 AS INTEGER) AS intensity, CAST(1 + l_orderkey % 3 AS INTEGER) AS number_of_returns, "
        "CAST(year(l_shipdate) * 372 + month(l_shipdate) * 31 + day(l_shipdate) AS DOUBLE) AS gps_time, CAST(l_partkey % 61 - 30 AS DOUBLE) AS scan_angle, "
        "l_orderkey AS ok, l_partkey AS pk",
    ),
    "buildings": (
        "customer",
        "c_custkey AS id, c_name AS building_id, c_mktsegment AS land_use_zone, c_acctbal AS acctbal, c_nationkey AS nation, c_nationkey % 5 AS region_id, "
        "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '' ELSE concat('G', CAST(c_custkey AS VARCHAR(20))) END AS gnaf_id, "
        "CAST(c_custkey * 7919 % 10007 AS DOUBLE) / 5.0 AS cx, CAST(c_custkey * 104729 % 10009 AS DOUBLE) / 5.0 AS cy, "
        "2.0 + c_nationkey % 5 AS hw, 1.0 + c_nationkey % 3 AS hh",
    ),
    "panoramas": (
        "part",
        "p_partkey AS pano_id, p_name AS name, CAST(p_partkey * 6151 % 10007 AS DOUBLE) / 5.0 AS x, CAST(p_partkey * 3571 % 10009 AS DOUBLE) / 5.0 AS y, CAST(p_size AS DOUBLE) * 7.2 AS heading",
    ),
    "tilesets": (
        "supplier",
        "s_suppkey AS tile_id, s_name AS file_name, s_nationkey % 5 AS region_id, CAST(s_suppkey % 10 AS DOUBLE) * 200.0 AS x0, CAST(floor(s_suppkey % 100 / 10) AS DOUBLE) * 200.0 AS y0, "
        "CAST(s_suppkey % 10 AS DOUBLE) * 200.0 + 200.0 AS x1, CAST(floor(s_suppkey % 100 / 10) AS DOUBLE) * 200.0 + 200.0 AS y1",
    ),
    "regions": (
        "region",
        "r_regionkey AS region_id, r_name AS region_name, CAST(r_regionkey AS DOUBLE) * 420.0 AS x0, 100.0 AS y0, CAST(r_regionkey AS DOUBLE) * 420.0 + 380.0 AS x1, 1900.0 AS y1",
    ),
    "clip_boxes": (
        "part",
        "p_partkey AS box_id, CAST(floor(p_partkey / 20) AS BIGINT) AS tile_id, CAST(p_size AS DOUBLE) * 2.0 - (3.0 + p_partkey % 4) AS x0, CAST(p_partkey % 50 AS DOUBLE) - (2.0 + p_partkey % 3) AS y0, "
        "CAST(p_size AS DOUBLE) * 2.0 + 3.0 + p_partkey % 4 AS x1, CAST(p_partkey % 50 AS DOUBLE) + 2.0 + p_partkey % 3 AS y1, p_partkey AS pk",
    ),
    "labels_long": (
        "orders",
        "o_orderkey AS row_id, concat('B', CAST(o_custkey AS VARCHAR(20))) AS building_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('G', CAST(o_orderkey % 5 AS VARCHAR(20))) END AS gnaf_id, "
        "CASE o_orderkey % 3 WHEN 0 THEN 'Survey Validation' WHEN 1 THEN 'NEXIS' ELSE 'Council Validation' END AS dataset, "
        "CASE o_orderkey % 4 WHEN 0 THEN 'Surveyed' WHEN 1 THEN 'Step counting' ELSE 'Model' END AS method, "
        "CASE WHEN o_orderkey % 8 = 5 THEN NULL ELSE o_totalprice / 99991.0 END AS floor_height_m",
    ),
    "detections_raw": (
        "events",
        "event_id, user_id AS id, concat('B', CAST(user_id AS VARCHAR(20))) AS building_id, value, "
        "CASE event_type WHEN 'click' THEN 'Front Door' WHEN 'view' THEN 'Foundation' WHEN 'purchase' THEN 'Garage Door' WHEN 'signup' THEN 'Stairs' WHEN 'error' THEN 'Window' ELSE event_type END AS class_name, "
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, value / (value + 50.0) AS confidence",
    ),
}
#: Views over other views.
DERIVED = {
    "detections": (
        "detections_raw",
        "event_id, id, building_id, class_name, confidence, k % 10 AS pano_id, k % 4 AS edge_idx, "
        "CASE k % 5 WHEN 0 THEN 'direct' WHEN 1 THEN 'semi_oblique_left' WHEN 2 THEN 'semi_oblique_right' WHEN 3 THEN 'oblique_left' ELSE 'oblique_right' END AS view_type, "
        "CAST(event_id % 1000 AS DOUBLE) AS x1, CAST(k AS DOUBLE) * 3.0 AS y1, CAST(event_id % 1000 AS DOUBLE) + 20.0 + value AS x2, CAST(k AS DOUBLE) * 3.0 + 30.0 + value / 2.0 AS y2",
    ),
}
VIEWS["detections_raw"] = (VIEWS["detections_raw"][0], VIEWS["detections_raw"][1])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in DERIVED:
        source, columns = DERIVED[name]
        df = view(spark, sf_dir, source)
    else:
        source, columns = VIEWS[name]
        df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    df.createOrReplaceTempView(f"__{source}")
    return spark.sql(f"SELECT {columns} FROM __{source}")


def ctes(*names: str) -> str:
    """WITH clause of the views that a query's oracle needs."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        if name in out:
            return
        if name in DERIVED:
            add(DERIVED[name][0])
        source, columns = (DERIVED | VIEWS)[name]
        out[name] = f"{name} AS (SELECT {columns} FROM {source})"

    for name in names:
        add(name)
    return "WITH " + ",\n".join(out.values())
