"""Typed staging frames; they are lazy and cost nothing until a mart reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions import labels
from millwatt.functions.numeric import half_up, numeric, ratio
from millwatt.operators.ordered import latest_per_key


def telemetry(raw: DataFrame) -> DataFrame:
    """Raw maps to wide typed columns, one per known metric."""
    return raw.select(
        "time",
        "device_id",
        "source",
        F.col("dimensions")["building"].alias("building"),
        F.col("dimensions")["equipmentType"].alias("equipment_type"),
        F.col("dimensions")["name"].alias("device_name"),
        F.col("metadata")["deviceId"].alias("metadata_device_id"),
        F.col("metadata")["topic"].alias("topic"),
        F.col("metadata")["schema_ver"].alias("schema_ver"),
        F.col("metadata")["msgId"].alias("msg_id"),
        *[numeric(F.col("value")[key]).alias(name) for name, key in C.METRIC_COLUMNS.items()],
    )


def _with_delta(df: DataFrame, supply: Column, back: Column, band: tuple[int, int]) -> DataFrame:
    gap = back - supply
    return df.select(
        "*",
        F.coalesce(gap, F.lit(0)).cast(df.schema["total_power"].dataType).alias("delta_temp"),
        gap.alias("delta_temp_nullable"),
        labels.supply_status(supply, band).alias("supply_temp_status"),
    )


def ahu(stg: DataFrame) -> DataFrame:
    """Air handling units with return minus supply and the supply band."""
    rows = stg.where(F.col("equipment_type") == "AHU")
    return _with_delta(rows, F.col("ahu_supply_temp"), F.col("ahu_return_temp"), C.AHU_SUPPLY_BAND)


def chiller(stg: DataFrame) -> DataFrame:
    """Chillers with return minus supply, that gap in percent of supply, and the supply band."""
    supply, back = F.col("chiller_cws_temp"), F.col("chiller_cwr_temp")
    rows = stg.where(F.col("equipment_type") == "Chillers")
    percent = half_up(ratio(back - supply, supply) * 100, 2)
    return _with_delta(rows, supply, back, C.CHILLER_SUPPLY_BAND).withColumn(
        "delta_pct", F.when(supply > 0, percent)
    )


def machine_readings(stg: DataFrame) -> DataFrame:
    """Power and energy of production machines."""
    return stg.where(F.col("equipment_type").isin(*C.MACHINE_TYPE_ORDER)).select(
        "time", "msg_id", "device_id", "device_name", "total_power", "total_energy"
    )


def live(raw: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row of every key that its last change did not delete.

    Rows are ordered by ``order``, then by source time and log position; tables captured without change
    columns have no deletes. Rows alike in all of these are told apart by their content.
    """
    change = [name for name in ("__source_ts_ms", "__lsn") if name in raw.columns and name not in order]
    rest = sorted(set(raw.columns) - {*keys, *order, *change})
    latest = latest_per_key(raw, keys, [*order, *change, *rest])
    for column, deleted in (("__op", "d"), ("__deleted", "true")):
        if column in raw.columns:
            latest = latest.where(~F.coalesce(F.col(column) == deleted, F.lit(False)))
    return latest


def machines(raw: DataFrame) -> DataFrame:
    """Latest production machine rows by source time, deleted ones left out."""
    latest = live(raw, ["machine_id"], ["__source_ts_ms"])
    return latest.where(F.col("machine_type").isin(*C.MACHINE_TYPE_ORDER)).select(
        "machine_id", "machine_type", "building", "energy_tag", "rated_power_kw", "is_active"
    )


def products(raw: DataFrame) -> DataFrame:
    """Products; of captured rows the latest of each, deleted ones left out."""
    rows = live(raw, ["product_id"], ["__source_ts_ms"]) if "__source_ts_ms" in raw.columns else raw
    return rows.select("product_id", "name", "sku", "family", "uom")


def work_orders(raw: DataFrame) -> DataFrame:
    """Latest work order rows by update time, deleted ones left out."""
    return live(raw, ["work_order_id"], ["updated_at"]).select(
        "work_order_id", "order_no", "product_id", "machine_id", "planned_qty", "due_date", "status"
    )


def production_runs(raw: DataFrame) -> DataFrame:
    """Runs in mart names; of captured rows the latest of each, deleted ones left out. The total is good plus scrap."""
    rows = live(raw, ["run_id"], ["__source_ts_ms"]) if "__source_ts_ms" in raw.columns else raw
    return rows.select(
        F.col("run_id").alias("id"),
        "work_order_id",
        "machine_id",
        "good_qty",
        "scrap_qty",
        (F.coalesce("good_qty", F.lit(0)) + F.coalesce("scrap_qty", F.lit(0))).alias("total_qty"),
        F.col("started_at").alias("start_time"),
        F.col("ended_at").alias("end_time"),
    )


def machine_states(raw: DataFrame) -> DataFrame:
    """States in mart names; of captured rows the latest of each, deleted ones left out. The source has no reason."""
    rows = live(raw, ["state_id"], ["__source_ts_ms"]) if "__source_ts_ms" in raw.columns else raw
    return rows.select(
        F.col("state_id").alias("id"),
        "machine_id",
        "state",
        F.col("started_at").alias("start_time"),
        F.col("ended_at").alias("end_time"),
        F.lit(None).cast("string").alias("reason"),
    )


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
