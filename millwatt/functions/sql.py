"""The record-shaping functions by name, for SQL users; they are SQL expressions, not Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "map_to_json": (
        "m MAP<STRING, DOUBLE>",
        "to_json(coalesce(m, cast(map() AS MAP<STRING, DOUBLE>)))",
    ),
    "meta_to_json": (
        "m MAP<STRING, STRING>",
        "to_json(coalesce(m, cast(map() AS MAP<STRING, STRING>)))",
    ),
    "build_dims": (
        "building STRING, equipment_type STRING, device_id STRING",
        "to_json(named_struct('building', building, 'equipmentType', equipment_type, 'name', device_id))",
    ),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL."""
    for name, (arguments, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS STRING RETURN {body}")
