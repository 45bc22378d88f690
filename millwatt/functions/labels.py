"""Codes, bands and labels derived from one or two columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwatt import constants as C


def lookup(value: Column, table: dict, otherwise: Column | None = None) -> Column:
    """``CASE value WHEN ...`` over a small fixed table."""
    chain = F
    for key, result in table.items():
        chain = chain.when(value == F.lit(key), F.lit(result))
    return chain.otherwise(F.lit(None) if otherwise is None else otherwise)


def building_code(building: Column) -> Column:
    codes = {name: code for name, (code, _) in C.BUILDINGS.items()}
    return lookup(building, codes, F.substring(building, 10, 2))


def building_order(building: Column) -> Column:
    orders = {name: order for name, (_, order) in C.BUILDINGS.items()}
    return lookup(building, orders, F.lit(C.OTHER_BUILDING_ORDER))


def machine_type_order(machine_type: Column) -> Column:
    return lookup(machine_type, C.MACHINE_TYPE_ORDER)


def day_part(hour: Column) -> Column:
    chain = F
    for name, (first, last) in C.DAY_PARTS.items():
        chain = chain.when(hour.between(first, last), F.lit(name))
    return chain.otherwise(F.lit(C.OTHER_DAY_PART))


def supply_status(supply: Column, band: tuple[int, int]) -> Column:
    """OK inside the inclusive band, WARN outside, MISSING without a reading."""
    return (
        F.when(supply.isNull(), F.lit("MISSING"))
        .when(supply.between(*band), F.lit("OK"))
        .otherwise(F.lit("WARN"))
    )


def is_true(text: Column) -> Column:
    """Text flag of the asset master; anything else, null included, is false."""
    return F.coalesce(F.lower(text.cast("string")).isin("true", "t", "1"), F.lit(False))


def tag(text: Column) -> Column:
    """Trimmed tag, null where it is empty or the text ``NULL``."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin("", "NULL"), trimmed)


def topic(source: Column, equipment_type: Column) -> Column:
    """Topic a device type is published to, ``<source>.unknown`` for other types."""
    unknown = F.concat(source, F.lit(".unknown"))
    return F.when(source == "bms", lookup(equipment_type, C.BMS_TOPICS, unknown)).otherwise(
        lookup(equipment_type, C.EMS_TOPICS, unknown)
    )
