"""SQL functions of the engine: temporary functions whose bodies are expressions, so Catalyst sees through them."""

from __future__ import annotations

from pyspark.sql import SparkSession

_BODIES = {
    "pl_bearing(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": "pmod(degrees(atan2(sin(radians(lon2 - lon1)) * cos(radians(lat2)), cos(radians(lat1)) * sin(radians(lat2)) - sin(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2 - lon1)))), 360D)",
    "pl_bearing_pixel(bearing DOUBLE, yaw DOUBLE, width INT) RETURNS INT": "least(greatest(CAST(bround(pmod((pmod(bearing - yaw + 180D, 360D) - 180D) / 360D * width + width / 2D, CAST(width AS DOUBLE)), 0) AS INT), 0), width - 1)",
    "pl_signed_angle(nx DOUBLE, ny DOUBLE, vx DOUBLE, vy DOUBLE) RETURNS DOUBLE": "degrees(atan2(nx * vy - ny * vx, nx * vx + ny * vy))",
    "pl_view_type(a DOUBLE) RETURNS STRING": "CASE WHEN abs(a) <= 15 + 1e-8 THEN 'direct' WHEN a BETWEEN 20 - 1e-8 AND 40 + 1e-8 THEN 'semi_oblique_left' WHEN a BETWEEN -40 - 1e-8 AND -20 + 1e-8 THEN 'semi_oblique_right' WHEN a BETWEEN 45 - 1e-8 AND 50 + 1e-8 THEN 'oblique_left' WHEN a BETWEEN -50 - 1e-8 AND -45 + 1e-8 THEN 'oblique_right' END",
    "pl_contrast(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "try_divide(a - b, a + b + 1e-6D)",
    "pl_cosine(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": "try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, v) -> s + v), sqrt(aggregate(a, 0D, (s, v) -> s + v * v)) * sqrt(aggregate(b, 0D, (s, v) -> s + v * v)))",
    "pl_quality_level(density DOUBLE) RETURNS STRING": "CASE WHEN density >= 8 THEN 'QL1' WHEN density >= 2 THEN 'QL2' WHEN density >= 0.5 THEN 'QL3' END",
    "pl_path_key(gnaf STRING) RETURNS STRING": "coalesce(nullif(gnaf, ''), 'NO_GNAF')",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Creates the functions in the session; returns their names."""
    for head, body in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in _BODIES]
