"""The geometry and time functions under their names in SQL, for a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from haulwatch.functions.geo import EARTH_RADIUS_M

_SECONDS = "int(split({0}, ':')[0]) * 3600 + int(split({0}, ':')[1]) * 60 + int(coalesce(get(split({0}, ':'), 2), '0'))"

FUNCTIONS = {
    "distance_m(lng1 DOUBLE, lat1 DOUBLE, lng2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE": (
        f"2 * {EARTH_RADIUS_M}D * asin(least(1.0D, sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)"
        " + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lng2 - lng1) / 2), 2))))"
    ),
    "second_of_day(sec BIGINT) RETURNS INT": "int(pmod(sec, 86400))",
    "clock_seconds(clock STRING) RETURNS INT": _SECONDS.format("clock"),
    "in_time_range(t INT, b INT, e INT) RETURNS BOOLEAN": (
        "CASE WHEN b > e THEN t < e OR t > b ELSE t > b AND t < e END"
    ),
}


def register(spark: SparkSession) -> None:
    """Temporary SQL functions; Spark inlines them, so they cost what their expression costs."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
