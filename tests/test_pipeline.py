from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows as table

from pyspark.sql import functions as F

from millwatt import schemas
from millwatt.operators import landing
from millwatt.plans import pipeline
from millwatt.session import work_folder
from millwatt.sources.files import erp_table, or_empty

NOON = datetime(2024, 5, 1, 12)


@pytest.fixture
def plant(spark, frame):
    def event(device, kind, minute, value, source):
        ts = int((NOON + timedelta(minutes=minute) - datetime(1970, 1, 1)).total_seconds() * 1000)
        meta = {"deviceId": device, "source": source, "msgId": f"{device}{minute}", "topic": "t", "schema_ver": "v1"}
        return (device, source, kind, "Building-Alpha", ts, value, meta)

    events = [event("B-1", "AHU", m, {"Supply_Temp": 14.0, "Return_Temp": 20.0 + m}, "bms") for m in range(3)]
    events += [event("M-1", "CNC", m, {"totalPower": 5.0, "totalEnergy": 10.0 + m}, "ems") for m in range(4)]
    events += events[:2] + events[-1:]  # replays
    raw = landing.land(frame(events, schemas.TELEMETRY_EVENT))
    master = frame(
        [(1, "A-01", "AHU", "Building-Alpha", "BA", "E-1", "B-1", "1", None, None, None, None)], schemas.MACHINE_MASTER
    )
    change = ("c", 1, 1, "false")
    erp = {name: erp_table(spark, work_folder(spark, "none"), name) for name in schemas.ERP_TABLES}
    full = lambda name: f"{schemas.ERP_TABLES[name]}, {schemas.CHANGE_COLUMNS}"
    erp["machines"] = frame(
        [
            ("M-1", "CNC", "Building-Alpha", "M-1", Decimal(30), True, NOON, *change),
            ("M-1", "CNC", "Building-Alpha", "M-1", Decimal(35), True, NOON, "u", 1, 2, "false"),
            ("M-2", "CNC", "Building-Alpha", "M-2", Decimal(9), True, NOON, *change),
            ("M-2", "CNC", "Building-Alpha", "M-2", Decimal(9), True, NOON, "d", 1, 3, "true"),
        ],
        full("machines"),
    )
    erp["products"] = frame([(1, "S", "Cover", "MOULDED", "EA", NOON, *change)], full("products"))
    erp["shifts"] = frame([(1, "A", 6, 14, "Crew", *change)], full("shifts"))
    erp["work_orders"] = frame(
        [
            (1, "WO-1", 1, "M-1", 10, date(2024, 5, 2), "PLANNED", NOON, NOON, *change),
            (1, "WO-1", 1, "M-1", 10, date(2024, 5, 2), "DONE", NOON, NOON + timedelta(hours=1), *change),
        ],
        full("work_orders"),
    )
    return raw, master, erp


def test_build_writes_marts_and_passes_its_checks(spark, plant):
    folder = work_folder(spark, "build")
    results = pipeline.build(spark, *plant, folder)
    assert results.count() == 44 and results.where("failures > 0").count() == 0
    energy = pipeline.mart(spark, folder, "fact_energy_reading")
    assert table(energy, "msg_id", "delta_kwh") == [("M-10", None), ("M-11", 1), ("M-12", 1), ("M-13", 1)]
    assert pipeline.mart(spark, folder, "fact_hvac_reading").count() == 3
    machines = pipeline.mart(spark, folder, "dim_machine")
    assert table(machines, "machine_id", "rated_power_kw") == [("M-1", Decimal(35))]  # the later of equal times; no deleted one
    production = pipeline.mart(spark, folder, "fact_production")
    assert table(production, "work_order_id", "status", "good_qty") == [(1, "DONE", None)]
    states = or_empty(spark, lambda: pipeline.mart(spark, folder, "fact_machine_state"), "machine_key bigint")
    assert states.count() == 0


def test_dimensions_are_refreshed_alone(spark, plant):
    _, master, erp = plant
    folder = work_folder(spark, "refresh")
    for _ in range(2):
        pipeline.refresh_dimensions(spark, master, erp["machines"], erp["products"], folder)
    assert [pipeline.mart(spark, folder, f"dim_{n}").count() for n in ("equipment", "machine", "product")] == [1, 1, 1]


def test_build_fails_on_bad_rows(spark, plant, frame):
    raw, master, erp = plant
    twice = master.unionByName(master.selectExpr("id + 1 as id", *master.columns[1:]))
    folder = work_folder(spark, "bad")
    pipeline.build(spark, raw, master, erp, folder)
    with pytest.raises(pipeline.ChecksFailed, match="dim_equipment.name unique: 1"):
        pipeline.build(spark, raw, twice, erp, folder)
    # Readers still see the marts of the build before.
    assert pipeline.mart(spark, folder, "dim_equipment").count() == 1
    assert pipeline.mart(spark, folder, "check_results").where("failures > 0").count() == 0


def test_models_are_lazy_frames(spark, plant):
    models = pipeline.models(spark, *plant)
    assert list(models)[:2] == ["dim_date", "dim_time"] and len(models) == 12


def test_upkeep_removes_what_is_not_used(spark, plant, frame):
    from millwatt.plans import upkeep
    from millwatt.sources import telemetry
    from millwatt.sources.changelog import ChangeTable

    folder = work_folder(spark, "upkeep")
    for _ in range(2):
        pipeline.build(spark, *plant, folder)
    assert pipeline.clean(spark, folder) == ["build=1"]
    assert pipeline.mart(spark, folder, "dim_machine").count() == 1 and pipeline.clean(spark, folder) == []

    raw, path, target = plant[0], work_folder(spark, "days"), work_folder(spark, "target")
    old = raw.limit(2).withColumn("time", F.col("time") - F.expr("INTERVAL 100 DAYS")).withColumn("date", F.to_date("time"))
    telemetry.write_raw(raw.unionByName(old), f"{path}/stream=a/batch_id=0")
    assert upkeep.compact(spark, path, target).count() == raw.count() + 2
    assert len(upkeep.retire(spark, path)) == 1 and telemetry.read_raw(spark, path).count() == raw.count()
    assert upkeep.retire(spark, path) == []

    table_ = ChangeTable(spark, work_folder(spark, "changes"), ["id"], "id int")
    table_.append(frame([(1, "c", 1, 1, "false")], "id int, __op string, __source_ts_ms bigint, __lsn bigint, __deleted string"), 0)
    assert upkeep.change_tables([table_]) == [0] and table_.current().count() == 1
