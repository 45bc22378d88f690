"""The model build: land, stage, dimensions, facts, checks; each layer is written before the next."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millwatt import constants as C
from millwatt.functions.clock import newest_time
from millwatt.operators import dims, facts, landing, quality, staging
from millwatt.session import configure
from millwatt.sources.files import delete_folder, exists, numbered_folders
from millwatt.sources.telemetry import by_device


class ChecksFailed(RuntimeError):
    """A declared check found bad rows; ``results`` has a row for every check."""

    def __init__(self, message: str, results: DataFrame):
        super().__init__(message)
        self.results = results


def models(
    spark: SparkSession,
    raw: DataFrame,
    master: DataFrame,
    erp: Mapping[str, DataFrame],
    calendar: DataFrame | None = None,
    state_tie: str = "id",
) -> dict[str, DataFrame]:
    """All marts as lazy frames, in build order. ``erp`` maps table names to landed tables."""
    configure(spark)
    stg = staging.telemetry(raw)
    dim_date = dims.calendar(spark) if calendar is None else calendar
    dim_time = dims.minutes(spark)
    dim_equipment = dims.equipment(master)
    dim_machine = dims.machine(staging.machines(erp["machines"]))
    dim_work_order = dims.work_order(staging.work_orders(erp["work_orders"]))
    intervals = facts.state_intervals(staging.machine_states(erp["machine_states"]), state_tie)
    return {
        "dim_date": dim_date,
        "dim_time": dim_time,
        "dim_location": dims.location(stg),
        "dim_equipment": dim_equipment,
        "dim_machine": dim_machine,
        "dim_product": dims.product(staging.products(erp["products"])),
        "dim_work_order": dim_work_order,
        "dim_shift": dims.shift(erp["shifts"]),
        "fact_hvac_reading": facts.hvac(
            staging.ahu(stg), staging.chiller(stg), dim_equipment, dim_date, dim_time
        ),
        "fact_energy_reading": facts.energy(stg, dim_machine, dim_date, dim_time),
        "fact_production": facts.production(
            dim_work_order, dim_machine, staging.production_runs(erp["production_runs"])
        ),
        "fact_machine_state": facts.machine_state(intervals, dim_machine, dim_date, dim_time),
    }


def write_silver(raw: DataFrame, path: str) -> None:
    """Typed staging rows by day, so marts and panels read single columns instead of maps.

    Replayed messages are removed here; the raw table keeps them. Rows are typed before the copies are looked for, so
    the sample of the ranges reads shuffled typed rows and does not take the maps apart again.
    """
    stg = landing.dedupe(staging.telemetry(raw), F.col("msg_id")).withColumn("date", F.to_date("time"))
    by_device(stg).write.mode("overwrite").partitionBy("date").option("compression", "zstd").parquet(path)


MANIFEST = "name string, path string, schema string"


def _manifests(spark: SparkSession, folder: str) -> dict[int, str]:
    """Published versions, by number."""
    found = numbered_folders(spark, f"{folder}/gold/manifest/version=*")
    return {n: path for n, path in found.items() if exists(spark, f"{path}/_SUCCESS")}


def _published(spark: SparkSession, folder: str) -> dict[str, tuple[str, str]]:
    """Path and schema of every table of the newest version: a dozen rows."""
    versions = _manifests(spark, folder)
    if not versions:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(versions[max(versions)]).collect()
    return {r.name: (r.path, r.schema) for r in rows}


def mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the newest published version; ``telemetry`` is the typed layer."""
    path, schema = _published(spark, folder)[name]
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)


class _Version:
    """Tables written beside the ones in use; :meth:`publish` makes readers see them, all at once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        numbers = numbered_folders(spark, f"{folder}/gold/build=*")
        self.root = f"{folder}/gold/build={max(numbers, default=0) + 1}"
        self.tables: dict[str, tuple[str, str]] = {}

    def write(self, name: str, df: DataFrame, day: str | None = None) -> DataFrame:
        """Write a table and read it back; with ``day``, by the day of that time."""
        path = f"{self.root}/{name}"
        if day:
            # Rebalancing cuts a busy day into several files and joins small pieces of the others.
            df = df.withColumn("day", F.to_date(day)).hint("rebalance", "day")
            df.write.mode("overwrite").partitionBy("day").option("compression", "zstd").parquet(path)
        else:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.add(name, path, df)

    def add(self, name: str, path: str, df: DataFrame) -> DataFrame:
        self.tables[name] = (path, df.schema.json())
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> None:
        """Switch readers: the tables written here, and the ones before for all others."""
        tables = _published(self.spark, self.folder) | self.tables
        number = max(_manifests(self.spark, self.folder), default=0) + 1
        rows = [(name, path, schema) for name, (path, schema) in tables.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.folder}/gold/manifest/version={number}")


def clean(spark: SparkSession, folder: str) -> list[str]:
    """Remove builds that the newest version does not use; run it when no reader is on them."""
    used = {path.rsplit("/", 1)[0].rsplit("=", 1)[1] for path, _ in _published(spark, folder).values()}
    gone = []
    for number, path in numbered_folders(spark, f"{folder}/gold/build=*").items():
        if str(number) not in used:
            delete_folder(spark, path)
            gone.append(f"build={number}")
    return sorted(gone)


def refresh_dimensions(
    spark: SparkSession, master: DataFrame, machines: DataFrame, products: DataFrame, folder: str
) -> None:
    """Publish equipment, machines and products from their current sources, between two builds."""
    configure(spark)
    version = _Version(spark, folder)
    version.write("dim_equipment", dims.equipment(master))
    version.write("dim_machine", dims.machine(staging.machines(machines)))
    version.write("dim_product", dims.product(staging.products(products)))
    version.publish()


def build(
    spark: SparkSession,
    raw: DataFrame,
    master: DataFrame,
    erp: Mapping[str, DataFrame],
    folder: str,
    calendar: DataFrame | None = None,
    state_tie: str = "id",
) -> DataFrame:
    """Write the typed layer and all marts as a new version under ``folder``, run every check, then publish.

    Each table is read back before others use it, so each is computed once. Raises
    :class:`ChecksFailed` when a check finds bad rows; readers then keep the version before.
    """
    configure(spark)
    version = _Version(spark, folder)
    stg_path = f"{version.root}/telemetry"
    write_silver(raw, stg_path)
    stg = spark.read.parquet(stg_path)
    version.add("telemetry", stg_path, stg)

    out: dict[str, DataFrame] = {"telemetry": raw}
    out["dim_date"] = version.write("dim_date", dims.calendar(spark) if calendar is None else calendar)
    out["dim_time"] = version.write("dim_time", dims.minutes(spark))
    out["dim_location"] = version.write("dim_location", dims.location(stg))
    out["dim_equipment"] = version.write("dim_equipment", dims.equipment(master))
    out["dim_machine"] = version.write("dim_machine", dims.machine(staging.machines(erp["machines"])))
    out["dim_product"] = version.write("dim_product", dims.product(staging.products(erp["products"])))
    out["dim_work_order"] = version.write(
        "dim_work_order", dims.work_order(staging.work_orders(erp["work_orders"]))
    )
    out["dim_shift"] = version.write("dim_shift", dims.shift(erp["shifts"]))
    days, clock, machines = out["dim_date"], out["dim_time"], out["dim_machine"]
    hvac = facts.hvac(staging.ahu(stg), staging.chiller(stg), out["dim_equipment"], days, clock)
    out["fact_hvac_reading"] = version.write("fact_hvac_reading", hvac, "time")
    out["fact_energy_reading"] = version.write("fact_energy_reading", facts.energy(stg, machines, days, clock), "time")
    out["fact_production"] = version.write(
        "fact_production",
        facts.production(out["dim_work_order"], machines, staging.production_runs(erp["production_runs"])),
    )
    intervals = facts.state_intervals(staging.machine_states(erp["machine_states"]), state_tie)
    out["fact_machine_state"] = version.write(
        "fact_machine_state", facts.machine_state(intervals, machines, days, clock), "start_time"
    )
    results = version.write("check_results", quality.run(out))
    failed = results.where("failures > 0")
    # One row per declared check, so this list is short whatever the data.
    broken = [f"{r.model}.{r.column} {r.test}: {r.failures}" for r in failed.collect()]
    if broken:
        raise ChecksFailed("; ".join(broken), results)
    version.publish()
    return results


def expire(raw: DataFrame, days: int = C.RETAIN_DAYS, as_of: Column | None = None) -> DataFrame:
    """Days a retention run would drop, as a list of ``date``: those ``days`` before ``as_of`` (the newest
    believable row) and older."""
    newest = F.to_date(newest_time(raw) if as_of is None else as_of)
    return raw.select("date").distinct().where(F.col("date") < F.date_sub(newest, days))
