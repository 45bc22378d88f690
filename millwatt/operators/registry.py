"""Device catalog: who reports what, in which range, on which topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions import labels
from millwatt.operators.signals import long_metrics


def calibrate(raw: DataFrame) -> DataFrame:
    """Observed range of every device and metric; a flat range is widened by 5 % and 0.5."""
    seen = long_metrics(raw).where(F.col("reading").isNotNull())
    ranges = seen.groupBy("device_id", "metric").agg(
        F.min("reading").alias("lo"), F.max("reading").alias("hi")
    )
    flat = F.col("lo") == F.col("hi")
    low = F.when(flat, F.col("lo") - F.abs("lo") * 0.05 - 0.5).otherwise(F.col("lo"))
    high = F.when(flat, F.col("hi") + F.abs("hi") * 0.05 + 0.5).otherwise(F.col("hi"))
    return ranges.select(
        "device_id", "metric", low.alias("lo"), high.alias("hi"), ((low + high) / 2).alias("nominal")
    )


def catalog(stg: DataFrame, master: DataFrame) -> DataFrame:
    """Devices seen, their topic, and the energy tag of the master asset with the same tag."""
    devices = stg.select(
        F.col("device_name").alias("device_id"), "source", "equipment_type", "building"
    ).distinct()
    tags = master.select(
        labels.tag(F.col("bmsTag")).alias("_tag"), labels.tag(F.col("energyTag")).alias("energy_tag")
    ).where(F.col("_tag").isNotNull())
    joined = devices.join(tags, devices["device_id"] == tags["_tag"], "left").drop("_tag")
    return joined.withColumn("topic", labels.topic(F.col("source"), F.col("equipment_type")))


def with_metrics(devices: DataFrame, ranges: DataFrame) -> DataFrame:
    """Catalog rows with their metric specifications as a sorted array."""
    spec = F.struct("metric", "lo", "hi", "nominal")
    specs = ranges.groupBy("device_id").agg(F.array_sort(F.collect_list(spec)).alias("metrics"))
    return devices.join(specs, "device_id", "left")


def expand_fleet(fleet: DataFrame) -> DataFrame:
    """One row per machine from ``building, machine_type, machines`` counts.

    Ids are building code, type code and a two-digit number; power limits come from the type.
    """
    kind = F.col("machine_type")
    limit = lambda place: labels.lookup(
        kind, {name: envelope[place] for name, envelope in C.POWER_ENVELOPE.items()}
    )
    numbered = fleet.where(F.col("machines") > 0).withColumn(
        "number", F.explode(F.sequence(F.lit(1), F.col("machines").cast("int")))
    )
    code = labels.building_code(F.col("building"))
    machine_id = F.format_string("%s-%s-%02d", code, labels.lookup(kind, C.MACHINE_TYPE_CODE), "number")
    return numbered.select(
        machine_id.alias("machine_id"),
        kind,
        "building",
        machine_id.alias("energy_tag"),
        limit(0).alias("idle_kw"),
        limit(1).alias("rated_power_kw"),
        limit(2).alias("nominal_kw"),
        labels.topic(F.lit("ems"), kind).alias("topic"),
    )
