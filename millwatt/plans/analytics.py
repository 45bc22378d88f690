"""Questions that cross climate, energy and production."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatt.functions.clock import hours_between
from millwatt.functions.numeric import NUMERIC, mean, ratio
from millwatt.operators.joins import as_of, with_shift, within_interval


def chiller_delta_vs_power(
    hvac: DataFrame, readings: DataFrame, dim_equipment: DataFrame, top: int = 10, bucket: str = "minute"
) -> DataFrame:
    """Chillers by mean power, with their mean return-supply gap over the same buckets.

    The asset's climate tag and energy tag meet on the bucket. Both sides are averaged per asset
    and bucket first, so the join is one row to one row. ``readings`` holds
    ``device_name, time, total_power``.
    """
    chillers = dim_equipment.where(F.col("equipment_type") == "Chiller").select(
        "equipment_key", "name", "energytag"
    )
    gaps = hvac.groupBy("equipment_key", F.date_trunc(bucket, "time").alias("bucket")).agg(
        F.sum("delta_temp_nullable").alias("gap_sum"), F.count("delta_temp_nullable").alias("gap_n")
    )
    power = readings.groupBy("device_name", F.date_trunc(bucket, "time").alias("bucket")).agg(
        F.sum("total_power").alias("power_sum"), F.count("total_power").alias("power_n")
    )
    joined = (
        gaps.join(chillers, "equipment_key")
        .join(power.withColumnRenamed("device_name", "energytag"), ["energytag", "bucket"])
    )
    return (
        joined.groupBy("equipment_key", "name")
        .agg(
            ratio(F.sum("gap_sum"), F.sum("gap_n")).alias("avg_chiller_delta_temp"),
            ratio(F.sum("power_sum"), F.sum("power_n")).alias("avg_power_kw"),
        )
        .drop("equipment_key")
        .orderBy(F.col("avg_power_kw").desc_nulls_last(), "name")
        .limit(top)
    )


def chiller_efficiency(
    hvac: DataFrame, readings: DataFrame, dim_equipment: DataFrame, bucket: str = "hour", step: float = 1.0
) -> DataFrame:
    """Power that chillers take for the heat they move, by chiller and load.

    Load is the mean return-supply gap of a bucket of time, in steps of ``step`` degrees; the source has no
    water flow, so heat is told by the gap alone. Buckets without a gap above zero have no load and do not
    count. Both sides are averaged per asset and bucket before they meet.
    """
    chillers = dim_equipment.where(F.col("equipment_type") == "Chiller").select("equipment_key", "name", "energytag")
    gaps = hvac.groupBy("equipment_key", F.date_trunc(bucket, "time").alias("bucket")).agg(
        mean(F.col("delta_temp_nullable")).alias("gap")
    )
    power = readings.groupBy(F.col("device_name").alias("energytag"), F.date_trunc(bucket, "time").alias("bucket")).agg(
        mean(F.col("total_power")).alias("power")
    )
    met = gaps.where("gap > 0").join(chillers, "equipment_key").join(power.where("power is not null"), ["energytag", "bucket"])
    banded = met.withColumn("load", F.floor(F.col("gap") / F.lit(float(step))) * F.lit(float(step)))
    exact = {name: F.sum(F.col(name).cast(NUMERIC)) for name in ("gap", "power")}
    return banded.groupBy("equipment_key", "name", "load").agg(
        F.count(F.lit(1)).alias("buckets"),
        ratio(exact["power"], F.count(F.lit(1))).alias("avg_power_kw"),
        ratio(exact["power"], exact["gap"]).alias("kw_per_degree"),
    )


def kwh_per_unit(energy: DataFrame, runs: DataFrame, shifts: DataFrame) -> DataFrame:
    """Energy used per good unit and shift.

    Both sides are summed to machine, shift day and shift before they meet, so neither is
    multiplied by the other. The join is full: energy of idle machines and units without energy
    both count.
    """
    used = (
        with_shift(energy, shifts, "time")
        .groupBy("machine_id", "shift_date", "shift_code")
        .agg(F.sum("delta_kwh_reset_safe").alias("kwh"))
    )
    made = (
        with_shift(runs, shifts, "start_time")
        .groupBy("machine_id", "shift_date", "shift_code")
        .agg(F.sum("good_qty").alias("units"))
    )
    both = used.join(made, ["machine_id", "shift_date", "shift_code"], "full_outer")
    return both.groupBy("shift_code").agg(
        F.coalesce(F.sum("kwh"), F.lit(0)).alias("total_kwh"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("total_units"),
        ratio(F.sum("kwh"), F.sum("units")).alias("kwh_per_unit"),
    )


def demand_peak(energy: DataFrame, shifts: DataFrame) -> DataFrame:
    """Highest total power of a minute by building, shift day and shift, and when it was.

    A machine that reports several times a minute counts with its mean of that minute.
    """
    known = energy.where(F.col("total_power").isNotNull())
    minute = F.date_trunc("minute", "time").alias("minute")
    each = known.groupBy("building", "device_id", minute).agg(F.avg("total_power").alias("power"))
    demand = each.groupBy("building", "minute").agg(F.round(F.sum("power"), 6).alias("power"))
    # The earlier minute wins a tie.
    place = F.struct("power", -F.unix_micros("minute"))
    return (
        with_shift(demand, shifts, "minute")
        .groupBy("building", "shift_date", "shift_code")
        .agg(F.max("power").alias("peak_power"), F.max_by("minute", place).alias("peak_time"))
    )


def energy_by_state(energy: DataFrame, intervals: DataFrame, tie: str = "id", **chunking) -> DataFrame:
    """Energy and mean power by machine and the state it was in."""
    readings = energy.select("machine_id", "time", "total_power", "delta_kwh_reset_safe")
    found = within_interval(
        readings, intervals, ["machine_id"], "time", "start_time", "end_time", tie, **chunking
    )
    return found.groupBy("machine_id", F.col("matched.state").alias("state")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum("delta_kwh_reset_safe").alias("kwh"),
        mean(F.col("total_power")).alias("avg_power"),
    )


def hvac_with_energy(hvac: DataFrame, energy: DataFrame, dim_equipment: DataFrame, **chunking) -> DataFrame:
    """Climate readings with the asset's latest energy reading not later than them."""
    tags = dim_equipment.where(F.col("energytag").isNotNull()).select("equipment_key", "energytag")
    left = hvac.select(
        "equipment_key", "msg_id", F.col("time").alias("reading_time"), "delta_temp_nullable"
    ).join(tags, "equipment_key")
    right = energy.select(
        F.col("device_name").alias("energytag"),
        F.col("time").alias("energy_time"),
        F.col("msg_id").alias("energy_msg_id"),
        "total_power",
    )
    found = as_of(
        left, right, ["energytag"], "reading_time", "energy_time", "energy_msg_id", **chunking
    )
    return found.select(
        "energytag",
        "msg_id",
        "reading_time",
        "delta_temp_nullable",
        "matched.energy_time",
        "matched.total_power",
    )


def oee(
    production: DataFrame, intervals: DataFrame, ideal_minutes_per_unit: float = 1.0
) -> DataFrame:
    """Availability, performance, quality and their product by machine and day.

    Availability is RUN time over recorded state time. The source holds no ideal rate, so it is an
    argument: performance is ideal minutes for the units made over the minutes runs took. Intervals
    and runs count on the day they begin.
    """
    hours = hours_between(F.col("end_time"), F.col("start_time"))
    states = intervals.where(F.col("end_time").isNotNull()).groupBy(
        "machine_id", F.to_date("start_time").alias("date_id")
    ).agg(
        F.sum(hours.cast("decimal(28,12)")).alias("state_hours"),
        F.sum(F.when(F.col("state") == "RUN", hours).cast("decimal(28,12)")).alias("run_hours"),
    )
    made = production.where(F.col("start_time").isNotNull()).groupBy(
        "machine_id", F.to_date("start_time").alias("date_id")
    ).agg(
        F.sum("good_qty").alias("good"),
        F.sum("total_qty").alias("total"),
        F.sum(F.col("duration_minutes").cast("decimal(28,12)")).alias("run_minutes"),
    )
    both = states.join(made, ["machine_id", "date_id"], "full_outer")
    parts = both.select(
        "machine_id",
        "date_id",
        ratio(F.coalesce("run_hours", F.lit(0)), F.col("state_hours")).alias("availability"),
        ratio(F.col("total") * F.lit(float(ideal_minutes_per_unit)), F.col("run_minutes")).alias("performance"),
        ratio(F.col("good"), F.col("total")).alias("quality"),
    )
    return parts.withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))


def schedule(work_orders: DataFrame, products: DataFrame, machines: DataFrame) -> DataFrame:
    """Work orders with product and machine, by due date."""
    goods = products.select("product_id", "sku", F.col("name").alias("product_name"))
    places = machines.select("machine_id", "machine_type", "building")
    return work_orders.join(goods, "product_id").join(places, "machine_id").orderBy(
        "due_date", "work_order_id"
    )


def machine_list(machines: DataFrame) -> DataFrame:
    return machines.orderBy("machine_id")


def hvac_vs_production(hvac: DataFrame, energy: DataFrame, production: DataFrame, dim_machine: DataFrame) -> DataFrame:
    """Climate load, machine power and units made by building and hour."""
    climate = hvac.groupBy("building", F.date_trunc("hour", "time").alias("hour")).agg(
        mean(F.col("delta_temp_nullable")).alias("avg_delta_temp")
    )
    load = energy.groupBy("building", F.date_trunc("hour", "time").alias("hour")).agg(
        F.sum("total_power").alias("machine_power"), F.sum("delta_kwh_reset_safe").alias("kwh")
    )
    places = dim_machine.select("machine_key", "building")
    made = (
        production.where(F.col("start_time").isNotNull())
        .groupBy("machine_key", F.date_trunc("hour", "start_time").alias("hour"))
        .agg(F.sum("good_qty").alias("units"))
        .join(places, "machine_key")
        .groupBy("building", "hour")
        .agg(F.sum("units").alias("units"))
    )
    return climate.join(load, ["building", "hour"], "full_outer").join(
        made, ["building", "hour"], "full_outer"
    )


def energy_by_building(energy: DataFrame) -> DataFrame:
    """Energy, mean and greatest power by building, machine type and day."""
    return energy.groupBy("building", "machine_type", "date_id").agg(
        F.sum("delta_kwh_reset_safe").alias("kwh"),
        mean(F.col("total_power")).alias("avg_power"),
        F.max("total_power").alias("max_power"),
    )


def run_shifts(runs: DataFrame, shifts: DataFrame) -> DataFrame:
    """Units made by shift day and shift."""
    return (
        with_shift(runs, shifts, "start_time")
        .groupBy("shift_date", "shift_code")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("good_qty").alias("good_qty"),
            F.sum("scrap_qty").alias("scrap_qty"),
        )
    )


def hvac_long(hvac_raw: DataFrame, dim_equipment: DataFrame, profiles: DataFrame) -> DataFrame:
    """Narrow climate fact: one row per asset, minute and metric, with the metric's unit.

    ``hvac_raw`` is the exploded reading table; ``profiles`` the fixed profile table.
    """
    assets = dim_equipment.select("equipment_key", "bmstag")
    units = profiles.select("equipment_type", "metric", "unit")
    joined = hvac_raw.join(assets, hvac_raw["device_id"] == assets["bmstag"]).join(
        F.broadcast(units), ["equipment_type", "metric"], "left"
    )
    return joined.select(
        "equipment_key",
        F.to_date("time").alias("date_id"),
        (F.hour("time") * 60 + F.minute("time")).alias("time_key"),
        "msg_id",
        "metric",
        "reading",
        "unit",
    )
