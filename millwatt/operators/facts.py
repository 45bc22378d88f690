"""Facts of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt.functions.clock import minute_of_day, minutes_between
from millwatt.functions.numeric import NUMERIC
from millwatt.operators import ordered, staging
from millwatt.operators.joins import with_children


def on_calendar(df: DataFrame, time: str, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Add ``date_id`` and ``time_key``; rows outside the calendar are dropped.

    The calendar has one row per day of its range and the clock 1440, so both are broadcast.
    """
    keyed = df.withColumn("date_id", F.to_date(time)).withColumn(
        "time_key", minute_of_day(F.col(time))
    )
    days, clock = dim_date.select("date_id"), dim_time.select("time_key")
    return keyed.join(F.broadcast(days), "date_id").join(F.broadcast(clock), "time_key")


def outside_calendar(df: DataFrame, time: str, dim_date: DataFrame) -> DataFrame:
    """How many rows :func:`on_calendar` would drop."""
    days = dim_date.select("date_id")
    per_day = df.groupBy(F.to_date(time).alias("date_id")).agg(F.count(F.lit(1)).alias("rows"))
    missing = per_day.join(days, "date_id", "left_anti")
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_outside_calendar"))


def _null_number() -> Column:
    return F.lit(None).cast(NUMERIC)


def hvac(
    stg_ahu: DataFrame,
    stg_chiller: DataFrame,
    dim_equipment: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
) -> DataFrame:
    """AHU and chiller readings of known equipment; each kind leaves the other's measures null."""
    common = ["time", "msg_id", "device_name", "building", "equipment_type", "delta_temp", "delta_temp_nullable",
              "supply_temp_status"]
    air = stg_ahu.select(
        *common,
        F.col("ahu_supply_temp").alias("supply_temp"),
        F.col("ahu_return_temp").alias("return_temp"),
        F.col("ahu_supply_rh").alias("supply_rh"),
        F.col("ahu_return_rh").alias("return_rh"),
        F.col("ahu_supply_flow").alias("supply_flow"),
        _null_number().alias("cws_temp"),
        _null_number().alias("cwr_temp"),
    )
    water = stg_chiller.select(
        *common,
        F.col("chiller_cws_temp").alias("cws_temp"),
        F.col("chiller_cwr_temp").alias("cwr_temp"),
    )
    readings = air.unionByName(water, allowMissingColumns=True)
    assets = dim_equipment.select("equipment_key", "bmstag")
    joined = readings.join(assets, readings["device_name"] == assets["bmstag"]).drop("bmstag")
    return on_calendar(joined, "time", dim_date, dim_time).select(
        "equipment_key",
        "date_id",
        "time_key",
        "time",
        "msg_id",
        "device_name",
        "building",
        "equipment_type",
        "supply_temp",
        "return_temp",
        "supply_rh",
        "return_rh",
        "supply_flow",
        "delta_temp",
        "delta_temp_nullable",
        "supply_temp_status",
        "cws_temp",
        "cwr_temp",
    )


def machine_readings(
    readings: DataFrame, dim_machine: DataFrame, dim_date: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """Staged machine readings with the keys of their machine, day and minute."""
    machines = dim_machine.select(
        "machine_key", "machine_id", "machine_type", "building", "building_code", "energy_tag"
    )
    joined = readings.join(machines, readings["device_name"] == machines["energy_tag"])
    return on_calendar(joined, "time", dim_date, dim_time).drop("device_name")


def energy(
    stg: DataFrame,
    dim_machine: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
    energy_mode: str = "counter",
    **chunking,
) -> DataFrame:
    """Machine readings with the energy used since the device's reading before.

    ``energy_mode="counter"``: the reading is a running counter; ``delta_kwh`` is the plain
    difference and ``delta_kwh_reset_safe`` takes the current value after a reset. With
    ``"bucket"`` the reading already is the amount of its interval and both equal it. Differences are
    taken after the joins; hot devices are found before them, on the staged rows alone.
    """
    if energy_mode not in ("counter", "bucket"):
        raise ValueError(f"unknown energy_mode: {energy_mode}")
    staged = staging.machine_readings(stg)
    now = F.col("total_energy")
    if energy_mode == "bucket":
        seen, delta = machine_readings(staged, dim_machine, dim_date, dim_time), now
    else:
        cut = ordered.chunked(staged, ["device_id"], ["time", "msg_id"], **chunking)
        readings = machine_readings(cut, dim_machine, dim_date, dim_time)
        seen = ordered.previous(readings, ["device_id"], ["time", "msg_id"], {"_before": now})
        delta = now - F.col("_before")
    delta = delta.cast(NUMERIC)
    return seen.select(
        "machine_key",
        "date_id",
        "time_key",
        "time",
        "msg_id",
        "device_id",
        "machine_id",
        "machine_type",
        "building",
        "building_code",
        "energy_tag",
        "total_power",
        "total_energy",
        delta.alias("delta_kwh"),
        F.when(delta < 0, now).otherwise(delta).alias("delta_kwh_reset_safe"),
    )


def production(dim_work_order: DataFrame, dim_machine: DataFrame, runs: DataFrame) -> DataFrame:
    """Work orders with their runs; orders without a run appear once with null measures."""
    machines = dim_machine.select("machine_key", F.col("machine_id").alias("_machine"))
    orders = dim_work_order.join(
        machines, dim_work_order["machine_id"] == machines["_machine"], "left"
    ).drop("_machine")
    ours = runs.select(
        F.col("work_order_id").alias("_order"),
        "good_qty",
        "scrap_qty",
        "total_qty",
        "start_time",
        "end_time",
    )
    return with_children(orders, ours, "work_order_id", "_order").select(
        "work_order_key",
        "machine_key",
        "work_order_id",
        "product_id",
        "machine_id",
        "planned_qty",
        "status",
        "good_qty",
        "scrap_qty",
        "total_qty",
        "start_time",
        "end_time",
        minutes_between(F.col("end_time"), F.col("start_time")).alias("duration_minutes"),
    )


def state_intervals(states: DataFrame, tie: str = "id", **chunking) -> DataFrame:
    """States with their end: the recorded one, else the start of the machine's next state."""
    ahead = ordered.following(
        states, ["machine_id"], ["start_time", tie], {"_next": F.col("start_time")}, **chunking
    )
    return ahead.select(
        *[name for name in states.columns if name != "end_time"],
        F.coalesce("end_time", "_next").alias("end_time"),
    )


def machine_state(
    intervals: DataFrame, dim_machine: DataFrame, dim_date: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """State intervals of known machines with their length."""
    joined = intervals.join(dim_machine.select("machine_key", "machine_id"), "machine_id")
    return on_calendar(joined, "start_time", dim_date, dim_time).select(
        "machine_key",
        "date_id",
        "time_key",
        "machine_id",
        "state",
        "start_time",
        "end_time",
        minutes_between(F.col("end_time"), F.col("start_time")).alias("duration_minutes"),
    )
