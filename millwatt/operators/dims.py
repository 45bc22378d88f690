"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions import labels
from millwatt.operators import ordered


def text_key(*natural: Column) -> Column:
    """Surrogate key for text natural keys: 60 bits of a digest.

    The same asset keeps its key in every rebuild and no sort is needed; the ``unique`` check on
    every surrogate key guards against a collision.
    """
    return F.conv(F.substring(F.md5(F.concat_ws("|", *natural)), 1, 15), 16, 10).cast("bigint")


def numbered_key(df: DataFrame, natural: str, name: str, **chunking) -> DataFrame:
    """Surrogate key 1..n along a unique serial key, without a global sort.

    A large table is cut into runs of ids with about a million rows each, dense or not; each run is
    sorted by one task, and the runs' sizes then shift the numbers.
    """
    return ordered.numbered(df, [], [natural], name, **chunking).drop(ordered.CHUNK)


def calendar(
    spark: SparkSession, start: str = C.CALENDAR_START, end: str = C.CALENDAR_END
) -> DataFrame:
    """Calendar of a fixed range."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("s"), F.lit(end).cast("date").alias("e"))
    return _calendar_days(bounds)


def calendar_of(df: DataFrame, time: str) -> DataFrame:
    """Calendar that covers the days seen in ``df``."""
    return _calendar_days(df.agg(F.min(F.to_date(time)).alias("s"), F.max(F.to_date(time)).alias("e")))


def _calendar_days(bounds: DataFrame) -> DataFrame:
    days = bounds.where(F.col("s").isNotNull()).select(
        F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("date_id")
    )
    day = F.col("date_id")
    return days.select(
        day,
        day.alias("full_date"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        (F.weekday(day) + 1).alias("day_of_week_iso"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_of_year"),
    )


def minutes(spark: SparkSession) -> DataFrame:
    """The 1440 minutes of a day."""
    key = F.col("time_key")
    hour, minute = F.expr("int(time_key div 60)"), key % 60
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return spark.range(1440).select(F.col("id").cast("int").alias("time_key")).select(
        key,
        hour.alias("hour_of_day"),
        minute.alias("minute_of_hour"),
        F.concat(two(hour), F.lit(":"), two(minute)).alias("time_label"),
        labels.day_part(hour).alias("time_of_day"),
    )


def location(stg: DataFrame) -> DataFrame:
    """Buildings seen in telemetry."""
    building = F.col("building")
    return (
        stg.where(building.isNotNull())
        .select("building")
        .distinct()
        .select(
            building,
            labels.building_code(building).alias("building_code"),
            labels.building_order(building).alias("building_order"),
            F.lit(C.CAMPUS).alias("campus"),
        )
    )


def equipment(master: DataFrame) -> DataFrame:
    """HVAC assets of the master; tags bridge to the telemetry device names."""
    return master.where(F.col("type").isin(*C.EQUIPMENT_TYPES)).select(
        text_key(F.col("id").cast("string"), F.col("name")).alias("equipment_key"),
        "id",
        "name",
        F.col("type").alias("equipment_type"),
        "building",
        F.col("buildingCode").alias("building_code"),
        labels.tag(F.col("energyTag")).alias("energytag"),
        labels.tag(F.col("bmsTag")).alias("bmstag"),
        labels.is_true(F.col("isactive")).alias("is_active"),
        "createdby",
        "createdon",
        "modifiedby",
        "modifiedon",
    )


def active(dim: DataFrame) -> DataFrame:
    """Assets in use; dropped assets stay in the dimension for their old facts."""
    return dim.where("is_active")


def machine(stg_machines: DataFrame) -> DataFrame:
    """Production machines."""
    return stg_machines.select(
        text_key(F.col("machine_id")).alias("machine_key"),
        "machine_id",
        "machine_type",
        "building",
        labels.building_code(F.col("building")).alias("building_code"),
        "energy_tag",
        "rated_power_kw",
        labels.machine_type_order(F.col("machine_type")).alias("machine_type_order"),
    )


def product(stg_products: DataFrame) -> DataFrame:
    return numbered_key(stg_products, "product_id", "product_key").select(
        "product_key", "product_id", F.col("name").alias("product_name"), "sku", "family", "uom"
    )


def work_order(stg_work_orders: DataFrame) -> DataFrame:
    """Work orders at their latest status."""
    return numbered_key(stg_work_orders, "work_order_id", "work_order_key").select(
        "work_order_key",
        "work_order_id",
        "order_no",
        "product_id",
        "machine_id",
        "planned_qty",
        "due_date",
        "status",
    )


def shift(shifts: DataFrame) -> DataFrame:
    return numbered_key(shifts, "shift_id", "shift_key").select(
        "shift_key", "shift_id", "shift_code", "start_hour", "end_hour", "crew"
    )
