"""Every operator as a query on the given tables.

Each function takes :class:`harness.views.Views` and returns a frame; :func:`present` turns decimals
to rounded doubles and times to zone-less ones, so results compare by value with the SQL twins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.views import Views, plant_events
from millwatt import constants as C
from millwatt.functions import registers, variants
from millwatt.operators import (
    changes,
    dims,
    facts,
    landing,
    quality,
    registry,
    rollups,
    signals,
    staging,
)
from millwatt.plans import analytics, panels, pipeline, upkeep
from millwatt.plans.daily import DailyBuild
from millwatt.session import work_folder, written
from millwatt.sources import files
from millwatt.sources import telemetry as telemetry_source
from millwatt.sources.keyed import HistoryTable, KeyedTable
from millwatt.sources.rawtable import RawTable
from millwatt.streaming import counters
from millwatt.streaming import energy as energy_stream
from millwatt.streaming import ingest, lateness, outages, windows
from millwatt.streaming.replays import ReplayIndex

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}
NOW = {"availableNow": True}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def present(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind in ("decimal", "double", "float"):
            column = F.round(column.cast("double"), 6)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        out.append(column.alias(field.name))
    return df.select(*out)


# Landing and upkeep.


@query
def land_telemetry(v: Views) -> DataFrame:
    raw = landing.land(v.events)
    dimensions = F.col("dimensions")
    return raw.select(
        F.col("metadata")["msgId"].alias("msg_id"),
        "time",
        "date",
        "device_id",
        "source",
        dimensions["building"].alias("building"),
        dimensions["equipmentType"].alias("equipment_type"),
        dimensions["name"].alias("name"),
        F.size("value").alias("metrics"),
    )


@query
def land_json(v: Views) -> DataFrame:
    """Landed rows with JSON text instead of maps, read back member by member."""
    rows = landing.land_json(v.events)
    return rows.select(
        F.get_json_object("metadata", "$.msgId").alias("msg_id"),
        "time",
        "dimensions",
        F.get_json_object("value", "$.totalPower").cast("double").alias("total_power"),
        F.get_json_object("value", "$.Return_Temp").cast("double").alias("return_temp"),
    )


@query
def topic_routing(v: Views) -> DataFrame:
    return landing.route_topics(v.events).groupBy("source", "equipmentType", "topic").agg(
        F.count(F.lit(1)).alias("records")
    ).withColumnRenamed("equipmentType", "equipment_type")


@query
def quarantine_split(v: Views) -> DataFrame:
    """Every message with what becomes of it; one set aside keeps its text, topic and offset."""
    decoded = landing.from_text_members(telemetry_source.decode_json(v.text_messages))
    outcome = F.coalesce(landing.quarantine_reason(F.lit("2100-01-01").cast("timestamp")), F.lit("landed"))
    return decoded.select(
        "offset",
        outcome.alias("outcome"),
        F.when(outcome != "landed", F.col("message")).alias("message"),
        F.when(outcome != "landed", F.col("topic")).alias("topic"),
        F.col("equipmentType").alias("equipment_type"),
        F.col("value")["totalPower"].alias("total_power"),
        F.col("value")["level"].alias("level"),
    )


@query
def variant_readings(v: Views) -> DataFrame:
    """Messages kept as they came in a ``VARIANT`` column, written and read back, and their members by path and type."""
    messages = v.text_messages.select("offset", variants.parse(F.col("value")).alias("body"))
    rows = written(messages, "variants")
    typed = variants.members(
        rows.withColumn("total_power", variants.number(F.col("body"), "$.value.totalPower")),
        "body",
        {
            "device_id": ("$.deviceId", "string"),
            "level": ("$.value.level", "int"),
            "power": ("$.value.totalPower", "double"),
            "device_number": ("$.deviceId", "double"),
            "value_number": ("$.value", "int"),
            "msg_id": ("$.metadata.msgId", "string"),
            "missing": ("$.metadata.none[0].x", "double"),
        },
    )
    return typed


@query
def compaction_candidates(v: Views) -> DataFrame:
    return landing.compaction_candidates(v.raw)


@query
def retention_filter(v: Views) -> DataFrame:
    kept = landing.within_retention(v.raw, days=14)
    return kept.groupBy("date", "source").agg(
        F.count(F.lit(1)).alias("records"), F.min("time").alias("oldest")
    )


@query
def retention_expired(v: Views) -> DataFrame:
    return pipeline.expire(v.raw, days=14)


def _per_day(raw: DataFrame) -> DataFrame:
    return raw.groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("device_id").alias("devices"), F.max("time").alias("newest")
    )


@query
def raw_by_day(v: Views) -> DataFrame:
    """The raw table written by day, clustered by device, and read back."""
    folder = work_folder(v.spark, "raw")
    telemetry_source.write_raw(v.raw, folder)
    return _per_day(telemetry_source.read_raw(v.spark, folder))


@query
def raw_compacted(v: Views) -> DataFrame:
    """The same after the compaction job, read from where it leaves the table."""
    folder = work_folder(v.spark, "compact")
    telemetry_source.write_raw(v.raw, f"{folder}/old/stream=a/batch_id=0")
    return _per_day(upkeep.compact(v.spark, f"{folder}/old", f"{folder}/new", files=4))


def _arrivals(v: Views) -> list[DataFrame]:
    """The raw rows as three landings: the first half of the serials, the second, and every seventh row, late."""
    serial = F.col("metadata")["msgId"].cast("bigint")
    half = v.raw.agg(F.max(serial)).first()[0] // 2
    late = serial % 7 == 0
    return [v.raw.where(~late & (serial <= half)), v.raw.where(~late & (serial > half)), v.raw.where(late)]


def _readings_of(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("metadata")["msgId"].alias("msg_id"), "time", "date", "device_id", "source", F.explode("value").alias("metric", "reading")
    )


@query
def raw_live(v: Views) -> DataFrame:
    """Every reading of a table that is compacted in place between three landings, the last into settled days."""
    folder = work_folder(v.spark, "live")
    table = RawTable(v.spark, folder)
    for number, rows in enumerate(_arrivals(v)):
        telemetry_source.write_raw(rows, f"{folder}/stream=a/batch_id={number}")
        upkeep.settle(v.spark, folder)
        if number != 1:
            table.clean()
    return _readings_of(telemetry_source.read_raw(v.spark, folder))


_BUILT: dict[tuple[str, str], DailyBuild] = {}


def _built_daily(v: Views) -> DailyBuild:
    """Marts built after each of three landings, with a compaction between the builds; once a session and folder, while they are there."""
    key = (v.spark.sparkContext.applicationId, v.folder)
    if key not in _BUILT or _BUILT[key].manifest.version() < 0:
        _BUILT[key] = _build_daily(v)
    return _BUILT[key]


def _build_daily(v: Views) -> DailyBuild:
    folder = work_folder(v.spark, "daily")
    raw, marts = RawTable(v.spark, f"{folder}/raw"), DailyBuild(v.spark, f"{folder}/marts")
    for number, rows in enumerate(_arrivals(v)):
        telemetry_source.write_raw(rows, f"{folder}/raw/stream=a/batch_id={number}")
        marts.run(raw, v.master, v.machines_raw)
        upkeep.settle(v.spark, f"{folder}/raw")
    return marts


@query
def build_incremental(v: Views) -> DataFrame:
    """The energy fact of marts built day by day as readings arrive, with the running energy carried over the days."""
    marts = _built_daily(v)
    totals = marts.totals().select("device_id", "msg_id", "total_kwh")
    return marts.energy().drop("date").join(totals, ["device_id", "msg_id"])


@query
def rollup_incremental(v: Views) -> DataFrame:
    """Hours merged from the minutes of the same marts, late readings included."""
    return _built_daily(v).hours()


@query
def raw_retained(v: Views) -> DataFrame:
    """What the retention job leaves of a streamed table that also holds a row of a wrong clock."""
    folder = work_folder(v.spark, "retain")
    wrong = v.raw.where("metadata['msgId'] = '0'").withColumn("time", F.lit("2950-01-01").cast("timestamp"))
    telemetry_source.write_raw(v.raw, f"{folder}/stream=a/batch_id=0")
    telemetry_source.write_raw(wrong.withColumn("date", F.to_date("time")), f"{folder}/stream=b/batch_id=0")
    upkeep.retire(v.spark, folder, days=14)
    return _per_day(telemetry_source.read_raw(v.spark, folder))


@query
def csv_master(v: Views) -> DataFrame:
    """The asset master through its CSV form, where missing values are the text NULL."""
    folder = work_folder(v.spark, "master")
    v.master.write.option("header", True).option("nullValue", "NULL").csv(folder)
    return files.read_machine_master(v.spark, folder).select(
        "id", "name", "type", "building", "buildingCode", "energyTag", "bmsTag", "isactive"
    )


@query
def message_dedupe(v: Views) -> DataFrame:
    """Every 50th message arrives twice; one copy stays."""
    twice = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    replayed = landing.land(v.events.withColumn("copy", F.explode(twice)))
    return landing.dedupe(replayed).select(
        F.col("metadata")["msgId"].alias("msg_id"), "time", "device_id", "source"
    )


# Change capture.


def _order_snapshot(v: Views, version: int, moved: int) -> DataFrame:
    """All orders of one version; every tenth has another number, so it comes and goes between snapshots."""
    number = F.col("work_order_id")
    log = v.work_order_log.where(F.col("version") == version)
    return log.select(
        F.when(number % 10 == 0, -number * 2 - moved).otherwise(number).alias("work_order_id"),
        "machine_id",
        "planned_qty",
        "status",
    )


@query
def cdc_events(v: Views) -> DataFrame:
    before = _order_snapshot(v, version=1, moved=0)
    after = _order_snapshot(v, version=2, moved=1)
    return changes.capture(before, after, ["work_order_id"]).select(
        "work_order_id",
        "op",
        F.col("before.status").alias("before_status"),
        F.col("before.planned_qty").alias("before_qty"),
        F.col("after.status").alias("after_status"),
        F.col("after.planned_qty").alias("after_qty"),
    )


@query
def cdc_unwrap(v: Views) -> DataFrame:
    return changes.unwrap(v.change_log).withColumnsRenamed(
        {"__op": "op", "__source_ts_ms": "ts_ms", "__lsn": "lsn", "__deleted": "deleted"}
    )


@query
def cdc_apply_latest(v: Views) -> DataFrame:
    state = changes.current(changes.unwrap(v.change_log), ["device_no"])
    return state.select("device_no", "status", "amount")


@query
def cdc_keep_deleted(v: Views) -> DataFrame:
    state = changes.current(changes.unwrap(v.change_log), ["device_no"], keep_deleted=True)
    return state.select("device_no", "status", "amount", F.col("__deleted").alias("deleted"))


@query
def cdc_route_counts(v: Views) -> DataFrame:
    return v.change_log.groupBy(changes.target_table(F.col("topic")).alias("table_name")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def schema_evolution_union(v: Views) -> DataFrame:
    first = v.work_order_log.where("version = 0").select("work_order_id", "machine_id", "due_date")
    second = v.work_order_log.where("version = 1").select("work_order_id", "machine_id", "due_date", "status")
    third = v.work_order_log.where("version = 2").select("work_order_id", "status", "planned_qty")
    return changes.evolve([first, second, third])


@query
def stg_work_orders_latest(v: Views) -> DataFrame:
    return v.work_orders


@query
def scd2_work_orders(v: Views) -> DataFrame:
    versions = changes.history(
        v.work_order_log, ["work_order_id"], ["status", "planned_qty"], "updated_at", ["version"]
    )
    return versions.select(
        "work_order_id", "status", "planned_qty", "valid_from", "valid_to", "is_current"
    )


# Staging.


@query
def scd2_from_batches(v: Views) -> DataFrame:
    """The same intervals kept up to date from four batches; the middle version comes last, in two of them."""
    log = v.work_order_log
    table = HistoryTable(
        v.spark,
        work_folder(v.spark, "history"),
        ["work_order_id"],
        ["status", "planned_qty"],
        "updated_at",
        ["version"],
        "work_order_id bigint, status string, planned_qty int, updated_at timestamp, version int",
        buckets=16,
    )
    middle = F.col("version") == 1
    even = F.col("work_order_id") % 2 == 0
    for number, part in enumerate([F.col("version") == 0, F.col("version") == 2, middle & even, middle & ~even]):
        table.merge(log.where(part), number)
    return table.intervals().select("work_order_id", "status", "planned_qty", "valid_from", "valid_to", "is_current")


@query
def cdc_upsert(v: Views) -> DataFrame:
    """Current state after three batches of changes, each rewriting only the buckets of its keys."""
    changed = changes.unwrap(v.change_log)
    image = "device_no bigint, status string, amount double"
    table = KeyedTable(v.spark, work_folder(v.spark, "upsert"), ["device_no"], image, buckets=16)
    for number in (1, 0, 2):  # the second batch comes first
        table.merge(changed.where(F.col("__lsn") % 3 == number), 0, f"log-{number}")
    return table.current().select("device_no", "status", "amount")


@query
def stg_telemetry(v: Views) -> DataFrame:
    return v.stg


@query
def stg_ahu(v: Views) -> DataFrame:
    return staging.ahu(v.stg).select(
        "msg_id", "time", "device_name", "building", "ahu_supply_temp", "ahu_return_temp",
        "delta_temp", "delta_temp_nullable", "supply_temp_status",
    )


@query
def stg_chiller(v: Views) -> DataFrame:
    return staging.chiller(v.stg).select(
        "msg_id", "time", "device_name", "building", "chiller_cws_temp", "chiller_cwr_temp",
        "delta_temp", "delta_temp_nullable", "delta_pct", "supply_temp_status",
    )


@query
def stg_machines_latest(v: Views) -> DataFrame:
    return staging.machines(v.machines_raw)


@query
def stg_runs(v: Views) -> DataFrame:
    return v.runs


@query
def erp_inventory(v: Views) -> DataFrame:
    wanted = ("machines", "products", "shifts", "work_orders")
    return staging.inventory({name: v.erp[name] for name in wanted})


# Dimensions.


@query
def dim_date(v: Views) -> DataFrame:
    """Calendar of the due dates, with the orders due on each day."""
    calendar = dims.calendar_of(v.table("orders"), "o_orderdate")
    due = v.table("orders").groupBy(F.to_date("o_orderdate").alias("date_id")).agg(
        F.count(F.lit(1)).alias("orders_due")
    )
    return calendar.join(due, "date_id", "left")


@query
def dim_time(v: Views) -> DataFrame:
    """Minutes of the day, with the readings taken in each."""
    key = F.hour("time") * 60 + F.minute("time")
    seen = v.raw.groupBy(key.alias("time_key")).agg(F.count(F.lit(1)).alias("readings"))
    return dims.minutes(v.spark).join(seen, "time_key", "left")


@query
def dim_location(v: Views) -> DataFrame:
    return dims.location(v.stg)


@query
def dim_equipment(v: Views) -> DataFrame:
    return v.dim_equipment


@query
def active_equipment(v: Views) -> DataFrame:
    return dims.active(v.dim_equipment).select("equipment_key", "id", "name", "equipment_type")


@query
def dim_machine(v: Views) -> DataFrame:
    return v.dim_machine


@query
def dim_product(v: Views) -> DataFrame:
    return dims.product(staging.products(v.products_raw))


@query
def dim_work_order(v: Views) -> DataFrame:
    return v.dim_work_order


@query
def dim_shift(v: Views) -> DataFrame:
    return dims.shift(v.shifts_raw)


# Facts.


@query
def fact_hvac(v: Views) -> DataFrame:
    return v.hvac


@query
def fact_hvac_long(v: Views) -> DataFrame:
    return analytics.hvac_long(signals.long_metrics(v.raw), v.dim_equipment, v.profiles)


@query
def fact_energy(v: Views) -> DataFrame:
    return v.energy


@query
def fact_energy_bucket(v: Views) -> DataFrame:
    """The same readings taken as amounts per interval."""
    bucket = facts.energy(v.stg, v.dim_machine, v.dim_date, v.dim_time, energy_mode="bucket")
    return bucket.groupBy("machine_id", "date_id").agg(F.sum("delta_kwh").alias("kwh"))


@query
def calendar_gaps(v: Views) -> DataFrame:
    """Work orders due outside the default calendar, which a join with it would drop."""
    return facts.outside_calendar(v.table("orders"), "o_orderdate", v.dim_date)


@query
def fact_production(v: Views) -> DataFrame:
    return v.production


@query
def fact_production_captured(v: Views) -> DataFrame:
    """Orders with their runs from a change log in which runs are finished later, and some removed."""
    return facts.production(v.dim_work_order, v.dim_machine, staging.production_runs(v.runs_log))


@query
def fact_machine_state_captured(v: Views) -> DataFrame:
    intervals = facts.state_intervals(staging.machine_states(v.states_log))
    return facts.machine_state(intervals, v.dim_machine, v.dim_date, v.dim_time)


@query
def state_intervals(v: Views) -> DataFrame:
    return v.intervals.select("id", "machine_id", "state", "start_time", "end_time")


@query
def fact_machine_state(v: Views) -> DataFrame:
    return facts.machine_state(v.intervals, v.dim_machine, v.dim_date, v.dim_time)


# Checks.


MODELS: dict[str, Query] = {
    "dim_date": lambda v: v.dim_date,
    "dim_time": lambda v: v.dim_time,
    "dim_location": dim_location,
    "dim_equipment": dim_equipment,
    "dim_machine": dim_machine,
    "dim_product": dim_product,
    "dim_work_order": dim_work_order,
    "dim_shift": dim_shift,
    "fact_hvac_reading": fact_hvac,
    "fact_energy_reading": fact_energy,
    "fact_production": fact_production,
    "fact_machine_state": fact_machine_state,
    "telemetry": lambda v: v.raw,
}


def _check(v: Views, checks: list[quality.Check]) -> DataFrame:
    """Results of ``checks`` on the models they name."""
    names = {check.model for check in checks} | {check.to_model for check in checks if check.to_model}
    return quality.run({name: MODELS[name](v) for name in names}, checks)


@query
def dq_not_null(v: Views) -> DataFrame:
    return _check(v, quality.NOT_NULL)


@query
def dq_source_not_null(v: Views) -> DataFrame:
    return _check(v, quality.SOURCE_NOT_NULL)


@query
def dq_unique(v: Views) -> DataFrame:
    return _check(v, quality.UNIQUE)


@query
def dq_relationships(v: Views) -> DataFrame:
    return _check(v, quality.RELATIONSHIPS)


@query
def dq_accepted_values(v: Views) -> DataFrame:
    return _check(v, quality.ACCEPTED_VALUES)


@query
def build_checks(v: Views) -> DataFrame:
    """All checks of a whole model build; readings without power make it one that is not published."""
    folder = work_folder(v.spark, "build")
    try:
        return pipeline.build(v.spark, v.raw, v.master, v.erp, folder)
    except pipeline.ChecksFailed as failed:
        return failed.results


@query
def dq_orphans(v: Views) -> DataFrame:
    """Relationship checks on the landed tables, where rows without a parent do occur."""
    checks = [
        quality.Check("work_orders", "machine_id", "relationships", to_model="machines", to_column="machine_id"),
        quality.Check("work_orders", "product_id", "relationships", to_model="products", to_column="product_id"),
        quality.Check("production_runs", "work_order_id", "relationships", to_model="work_orders", to_column="work_order_id"),
        quality.Check("production_runs", "run_id", "unique"),
        quality.Check("production_runs", "ended_at", "not_null"),
        quality.Check("machines", "machine_type", "accepted_values", tuple(C.MACHINE_TYPE_ORDER)),
    ]
    return quality.run(v.erp, checks)


@query
def dq_contract(v: Views) -> DataFrame:
    rules = v.profiles.select(
        "equipment_type",
        "metric",
        (F.col("setpoint") - 15).alias("lo"),
        (F.col("setpoint") + 15).alias("hi"),
    )
    return quality.contract(v.raw, rules, stale_after_minutes=30)


# Panels.


@query
def panel_supply_temp(v: Views) -> DataFrame:
    return panels.supply_temp(v.stg)


@query
def panel_return_temp(v: Views) -> DataFrame:
    return panels.return_temp(v.stg)


@query
def panel_chiller_dt(v: Views) -> DataFrame:
    return panels.chiller_delta(v.stg)


@query
def panel_power_by_building(v: Views) -> DataFrame:
    return panels.power_by_building(v.stg)


@query
def panel_power_by_type(v: Views) -> DataFrame:
    return panels.power_by_type(v.stg)


@query
def panel_power_by_type_hourly(v: Views) -> DataFrame:
    """The same panel over the whole range in hours."""
    return panels.power_by_type(v.stg, bucket="hour", hours=24 * 366)


@query
def panel_cumulative_energy(v: Views) -> DataFrame:
    return panels.cumulative_energy(v.stg)


@query
def telemetry_freshness(v: Views) -> DataFrame:
    return panels.freshness(v.raw)


# Cross-domain questions.


def _power(v: Views) -> DataFrame:
    return v.readings.select(F.col("energy_tag").alias("device_name"), "time", "msg_id", "total_power")


@query
def chiller_dt_vs_power(v: Views) -> DataFrame:
    return analytics.chiller_delta_vs_power(v.hvac, _power(v), v.dim_equipment, bucket="day")


@query
def chiller_efficiency(v: Views) -> DataFrame:
    return analytics.chiller_efficiency(v.hvac, _power(v), v.dim_equipment, bucket="day")


@query
def kwh_per_unit_by_shift(v: Views) -> DataFrame:
    return analytics.kwh_per_unit(v.energy, v.runs, v.shifts_raw)


@query
def demand_peak_by_shift(v: Views) -> DataFrame:
    return analytics.demand_peak(v.readings, v.shifts_raw)


@query
def energy_by_building(v: Views) -> DataFrame:
    return analytics.energy_by_building(v.energy)


@query
def energy_by_state(v: Views) -> DataFrame:
    return analytics.energy_by_state(v.written("energy"), v.written("intervals"))


@query
def asof_hvac_energy(v: Views) -> DataFrame:
    return analytics.hvac_with_energy(v.hvac, _power(v), v.dim_equipment)


@query
def oee(v: Views) -> DataFrame:
    made = v.runs.withColumn(
        "duration_minutes",
        (F.unix_micros("end_time") - F.unix_micros("start_time")) / F.lit(60e6),
    )
    return analytics.oee(made, v.intervals)


@query
def schedule(v: Views) -> DataFrame:
    return analytics.schedule(v.work_orders, v.products_raw, staging.machines(v.machines_raw))


@query
def machine_list(v: Views) -> DataFrame:
    return analytics.machine_list(staging.machines(v.machines_raw))


@query
def run_shift(v: Views) -> DataFrame:
    return analytics.run_shifts(v.runs, v.shifts_raw)


@query
def hvac_vs_production(v: Views) -> DataFrame:
    made = v.runs.join(v.dim_machine.select("machine_key", "machine_id"), "machine_id")
    return analytics.hvac_vs_production(v.hvac, v.energy, made, v.dim_machine)


# Roll-ups and signals.


@query
def rollup_minute(v: Views) -> DataFrame:
    return rollups.by_minute(v.energy)


@query
def rollup_hour(v: Views) -> DataFrame:
    return rollups.by_hour(rollups.by_minute(v.energy))


def _power_readings(v: Views) -> DataFrame:
    return v.stg.where(F.col("source") == "ems").select("device_id", "time", "msg_id", "total_power")


@query
def energy_integrate(v: Views) -> DataFrame:
    return signals.integrate_energy(_power_readings(v))


@query
def anomaly_power_spike(v: Views) -> DataFrame:
    return signals.spikes(_power_readings(v))


@query
def late_audit(v: Views) -> DataFrame:
    """Every 13th event carries a time two minutes back."""
    back = F.when(F.col("event_id") % 13 == 0, 120_000).otherwise(0)
    arrivals = v.events.select(
        F.col("event_id").alias("arrival"), F.timestamp_millis(F.col("ts_utc") - back).alias("time")
    )
    return signals.late_rows(arrivals, "arrival")


@query
def state_transition_check(v: Views) -> DataFrame:
    return signals.state_steps(v.states).select(
        "id", "machine_id", "previous_state", "state", "allowed"
    )


@query
def stuck_value(v: Views) -> DataFrame:
    readings = v.events.select(
        F.col("deviceId").alias("device_id"),
        F.timestamp_millis("ts_utc").alias("time"),
        "event_id",
        F.floor(F.col("k") / 34).alias("level"),
    )
    return signals.stuck_values(readings, ["device_id"], "level", ["time", "event_id"])


@query
def setpoint_deviation(v: Views) -> DataFrame:
    return signals.setpoint_deviation(v.raw, v.profiles)


@query
def low_delta(v: Views) -> DataFrame:
    columns = ["msg_id", "equipment_type", "delta_temp_nullable"]
    both = staging.ahu(v.stg).select(*columns).unionByName(staging.chiller(v.stg).select(*columns))
    return signals.low_delta(both)


# Devices.


@query
def device_catalog(v: Views) -> DataFrame:
    return v.catalog


@query
def metric_calibration(v: Views) -> DataFrame:
    return registry.calibrate(v.raw)


@query
def device_metric_counts(v: Views) -> DataFrame:
    """Catalog with its metric specifications, told by their number and first key."""
    full = registry.with_metrics(v.catalog, registry.calibrate(v.raw))
    return full.select(
        "device_id", F.size("metrics").alias("metrics"), F.col("metrics")[0]["metric"].alias("first_metric")
    )


@query
def fleet_expand(v: Views) -> DataFrame:
    return registry.expand_fleet(v.fleet)


@query
def register_decode(v: Views) -> DataFrame:
    k, n = F.col("k"), F.col("event_id").cast("int")
    block = F.array(k * 3 + 16000, n % 65536, k + 49000, (n * 7) % 65536)
    keys = F.array(F.lit("totalPower"), F.lit("totalEnergy"))
    decoded = v.events.select("event_id", registers.decode_metrics(block, keys).alias("m"))
    return decoded.select(
        "event_id",
        F.col("m")["totalPower"].alias("total_power"),
        F.col("m")["totalEnergy"].alias("total_energy"),
    )


@query
def register_round_trip(v: Views) -> DataFrame:
    """Readings written to registers and read back lose what a single cannot hold, no more."""
    reading = F.col("reading")
    block = registers.encode_block(F.array(reading, -reading / 3))
    written = signals.long_metrics(v.raw).withColumn("block", block)
    read = written.withColumn("back", registers.decode_block(F.col("block")))
    return read.select("msg_id", "metric", F.col("back")[0].alias("first"), F.col("back")[1].alias("second"))


# Streams, each run to the end of its input.


@query
def ingest_stream(v: Views) -> DataFrame:
    folder = work_folder(v.spark, "ingest")
    events = plant_events(v.stream("events")).select(
        "deviceId", "source", "equipmentType", "building", "ts_utc", "value", "metadata"
    )
    ingest.start(events, f"{folder}/raw", f"{folder}/quarantine", f"{folder}/checkpoint", NOW).awaitTermination()
    landed = telemetry_source.read_raw(v.spark, f"{folder}/raw")
    return landed.select(
        F.col("metadata")["msgId"].alias("msg_id"), "time", "date", "device_id", "source", F.explode("value").alias("metric", "reading")
    )


@query
def ingest_replayed(v: Views) -> DataFrame:
    """Events landed by one stream, and all of them again by a stream with a checkpoint of its own."""
    folder = work_folder(v.spark, "replayed")
    events = plant_events(v.stream("events")).select(
        "deviceId", "source", "equipmentType", "building", "ts_utc", "value", "metadata"
    )
    index = ReplayIndex(v.spark, f"{folder}/ids")
    for name in ("a", "b"):
        ingest.start(events, f"{folder}/raw", f"{folder}/bad", f"{folder}/state-{name}", NOW, index=index).awaitTermination()
    return _readings_of(telemetry_source.read_raw(v.spark, f"{folder}/raw"))


@query
def ingest_quarantine(v: Views) -> DataFrame:
    """JSON messages landed by two streams with checkpoints of their own; all that is set aside, as it came."""
    folder = work_folder(v.spark, "quarantine")
    v.text_messages.write.parquet(f"{folder}/messages")
    schema = v.text_messages.schema
    for half in ("a", "b"):
        messages = v.spark.readStream.schema(schema).parquet(f"{folder}/message[s]")
        mine = messages.where(F.col("offset") % 2 == (0 if half == "a" else 1))
        decoded = telemetry_source.decode_json(mine)
        ingest.start(decoded, f"{folder}/raw", f"{folder}/bad", f"{folder}/state-{half}", NOW).awaitTermination()
    aside = v.spark.read.parquet(f"{folder}/bad").select("offset", "reason", "message", "topic")
    landed = telemetry_source.read_raw(v.spark, f"{folder}/raw")
    rows = landed.select(F.col("metadata")["msgId"].cast("bigint").alias("offset"), F.lit("landed").alias("reason"))
    return aside.unionByName(rows, allowMissingColumns=True)


@query
def stream_outages(v: Views) -> DataFrame:
    """Devices that fell silent for a day, told by a stream of the events without some days of some devices."""
    folder = work_folder(v.spark, "outages")
    events = plant_events(v.stream("events"))
    time = F.timestamp_millis("ts_utc")
    # Planted gaps: every third device says nothing on three days.
    planted = (F.col("user_id") % 3 == 0) & F.dayofmonth(time).between(10, 12)
    readings = events.where(~planted).select(F.col("deviceId").alias("device_id"), F.col("equipmentType").alias("equipment_type"), time.alias("time"))
    outages.start(readings, f"{folder}/out", f"{folder}/checkpoint", "1 day", trigger=NOW).awaitTermination()
    return v.spark.read.parquet(f"{folder}/out")


@query
def stream_tumbling(v: Views) -> DataFrame:
    folder = work_folder(v.spark, "tumbling")
    raw = landing.land(plant_events(v.stream("events"))).where(F.col("source") == "ems")
    rolled = windows.tumbling(raw, length="1 hour")
    (
        rolled.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**NOW)
        .start()
        .awaitTermination()
    )
    return v.spark.read.schema(rolled.schema).parquet(f"{folder}/out")


@query
def stream_dedup(v: Views) -> DataFrame:
    """Every 50th message arrives twice; one copy stays."""
    folder = work_folder(v.spark, "dedup")
    events = plant_events(v.stream("events"))
    twice = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    replayed = events.withColumn("copy", F.explode(twice)).select(
        F.col("metadata")["msgId"].alias("msg_id"),
        F.timestamp_millis("ts_utc").alias("time"),
        F.col("deviceId").alias("device_id"),
        F.col("copy").alias("arrival"),
    )
    unique = windows.deduplicated(replayed).drop("arrival")
    (
        unique.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**NOW)
        .start()
        .awaitTermination()
    )
    return v.spark.read.schema(unique.schema).parquet(f"{folder}/out")


@query
def stream_energy(v: Views) -> DataFrame:
    folder = work_folder(v.spark, "energy")
    raw = landing.land(plant_events(v.stream("events")))
    readings = staging.telemetry(raw).where(F.col("source") == "ems").select(
        "device_id", "time", "msg_id", "total_power"
    )
    energy_stream.start(readings, f"{folder}/out", f"{folder}/checkpoint", NOW).awaitTermination()
    return v.spark.read.parquet(f"{folder}/out/totals").drop("stream", "batch_id", "total_work")


@query
def stream_energy_state(v: Views) -> DataFrame:
    """Running energy from the stream's own state, in three runs that each go on from the checkpoint of the one before."""
    folder = work_folder(v.spark, "counters")
    readings = _power_readings(v).withColumn("total_power", F.col("total_power").cast("decimal(28,12)"))
    first, newest = readings.agg(F.min("time"), F.max("time")).first()
    thirds = [first + (newest - first) * k / 3 for k in (1, 2)]
    at = F.col("time")
    for part in (at < thirds[0], (at >= thirds[0]) & (at < thirds[1]), at >= thirds[1]):
        readings.where(part).write.mode("append").parquet(f"{folder}/readings")
        stream = v.spark.readStream.schema(readings.schema).parquet(f"{folder}/reading[s]")
        counters.start(stream, f"{folder}/out", f"{folder}/checkpoint", idle="3 days", trigger=NOW).awaitTermination()
    out = v.spark.read.parquet(f"{folder}/out")
    return out.where("kind = 'total'").select("device_id", "time", "msg_id", "total_power", "total_kwh")


@query
def stream_cdc(v: Views) -> DataFrame:
    """Change stream applied batch by batch to a keyed table."""
    from millwatt.sources.changelog import ChangeTable

    folder = work_folder(v.spark, "cdc")
    image = "device_no bigint, status string, amount double"
    table = ChangeTable(v.spark, f"{folder}/table", ["device_no"], image)
    stream = changes.unwrap(v.change_envelopes(v.stream("events")))
    (
        stream.writeStream.foreachBatch(table.sink(f"{folder}/checkpoint"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**NOW)
        .start()
        .awaitTermination()
    )
    return table.current().select("device_no", "status", "amount")


@query
def stream_late_audit(v: Views) -> DataFrame:
    """The audit over a stream of the events in two files, the second half of the serials last."""
    folder = work_folder(v.spark, "late")
    back = F.when(F.col("event_id") % 13 == 0, 120_000).otherwise(0)
    rows = v.events.select("event_id", "ts_utc")
    half = rows.agg(F.max("event_id")).first()[0] // 2
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        rows.where(part).write.mode("append").parquet(f"{folder}/events")
        stream = v.spark.readStream.schema(rows.schema).parquet(f"{folder}/event[s]")
        arrivals = stream.select(
            F.col("event_id").alias("arrival"), F.timestamp_millis(F.col("ts_utc") - back).alias("time")
        )
        lateness.start(arrivals, f"{folder}/out", f"{folder}/checkpoint", trigger=NOW).awaitTermination()
    return v.spark.read.schema("arrival bigint, time timestamp, newest timestamp").parquet(f"{folder}/out/late").select("arrival", "time", "newest")


def run(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return present(QUERIES[name](Views(spark, folder)))
