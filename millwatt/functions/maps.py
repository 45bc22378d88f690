"""Maps and the JSON text of a landed record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def values_json(values: Column) -> Column:
    """Reading map as a JSON object of numbers; a missing map is an empty object."""
    return F.to_json(F.coalesce(values.cast("map<string,double>"), F.expr("cast(map() as map<string,double>)")))


def metadata_json(metadata: Column) -> Column:
    """Metadata map as a JSON object of texts; a missing map is an empty object."""
    return F.to_json(F.coalesce(metadata.cast("map<string,string>"), F.expr("cast(map() as map<string,string>)")))


def dimensions(building: Column, equipment_type: Column, device_id: Column) -> Column:
    return F.create_map(
        F.lit("building"), building,
        F.lit("equipmentType"), equipment_type,
        F.lit("name"), device_id,
    )


def dimensions_json(building: Column, equipment_type: Column, device_id: Column) -> Column:
    return F.to_json(
        F.struct(
            building.alias("building"),
            equipment_type.alias("equipmentType"),
            device_id.alias("name"),
        )
    )


def _number(value: Column) -> Column:
    """Text as a finite number, else null: NaN and infinities sort above every reading."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def numeric_members(values: Column) -> Column:
    """Members of a text map that are finite numbers, as doubles."""
    parsed = F.transform_values(values, lambda _, v: _number(v))
    return F.map_filter(parsed, lambda _, v: v.isNotNull())


def bad_members(values: Column) -> Column:
    """Keys of a text map whose value is present but no finite number."""
    bad = F.map_filter(values, lambda _, v: v.isNotNull() & _number(v).isNull())
    return F.array_sort(F.map_keys(bad))
