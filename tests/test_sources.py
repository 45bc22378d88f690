from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from conftest import rows as table
from pyspark.sql import functions as F

from millwatt import schemas
from millwatt.operators import landing
from millwatt.plans import panels, pipeline
from millwatt.session import work_folder
from millwatt.sources import files, telemetry


def test_asset_master_reads_null_text(spark, tmp_path):
    path = tmp_path / "master.csv"
    path.write_text(
        "id,name,type,building,buildingCode,energyTag,bmsTag,isactive,createdby,createdon,modifiedby,modifiedon\n"
        "1,C-01,Chiller,Building-Alpha,BA,E-1,B-1,1,NULL,NULL,NULL,NULL\n"
        "2,T-01,Cooling Tower,Building-Alpha,BA,E-2,NULL,0,NULL,NULL,NULL,NULL\n"
    )
    got = files.read_machine_master(spark, str(path))
    assert table(got, "id", "bmsTag", "createdby") == [(1, "B-1", None), (2, None, None)]


def test_samples(spark, tmp_path):
    bms = tmp_path / "bms.csv"
    bms.write_text(
        "timebucket,name,building,equipmentType,value\n"
        '2024-01-07 23:00:00.0000000,A,Building-Alpha,AHU,"{""Supply_Temp"": -1.5, ""Return_Temp"": ""x""}"\n'
    )
    got = files.read_bms_sample(spark, str(bms)).first()
    assert got.timebucket == datetime(2024, 1, 7, 23) and got.value == {"Supply_Temp": "-1.5", "Return_Temp": "x"}
    ems = tmp_path / "ems.csv"
    ems.write_text("timebucket,name,building,totalEnergy,totalPower\n2024-01-07 23:00:00.0000000,M,B,12.50000000,12.5\n")
    got = files.read_ems_sample(spark, str(ems)).first()
    assert (got.timebucket, float(got.totalEnergy), float(got.totalPower)) == (datetime(2024, 1, 7, 23), 12.5, 12.5)


def raw_frame(frame, days=3, per_day=50):
    start = datetime(2024, 5, 1)
    rows = []
    for day in range(days):
        for i in range(per_day):
            time = start + timedelta(days=day, minutes=i)
            device = f"d{i % 5}"
            rows.append((time, {"x": float(i)}, {"name": device}, {"deviceId": device}, device, "bms", time.date()))
    return frame(rows, schemas.RAW_TELEMETRY)


def test_raw_table_by_day(spark, frame):
    path, target = work_folder(spark, "raw"), work_folder(spark, "compact")
    raw = raw_frame(frame)
    telemetry.write_raw(raw, path)
    back = telemetry.read_raw(spark, path)
    assert table(back.groupBy("date").count()) == [(date(2024, 5, d), 50) for d in (1, 2, 3)]
    telemetry.compact_days(spark, path, target, before="2024-05-03", files=2)
    old = telemetry.read_raw(spark, target)
    assert old.count() == 150 and len(old.where("date < '2024-05-03'").inputFiles()) <= 7
    assert table(old.groupBy("date").count()) == table(back.groupBy("date").count())
    assert telemetry.retained(back, F.lit("2024-05-02").cast("date")).count() == 100
    assert table(pipeline.expire(back, days=1)) == [(date(2024, 5, 1),)]
    assert landing.within_retention(back, days=1).count() == 51
    assert table(landing.compaction_candidates(back, days=1), "date", "rows", "devices") == [(date(2024, 5, 1), 50, 5)]


def test_expired_days_are_dropped(spark, frame):
    path = work_folder(spark, "drop")
    telemetry.write_raw(raw_frame(frame), path)
    assert telemetry.drop_days(spark, path, "2024-05-03") == ["date=2024-05-01", "date=2024-05-02"]
    assert table(telemetry.read_raw(spark, path).select("date").distinct()) == [(date(2024, 5, 3),)]
    assert telemetry.drop_days(spark, path, "2024-05-03") == []


def test_streamed_days_are_dropped_and_one_bad_clock_expires_nothing(spark, frame):
    path = work_folder(spark, "streamed")
    raw = raw_frame(frame)
    bad = raw.limit(1).withColumn("time", F.lit("2952-01-01").cast("timestamp")).withColumn("date", F.to_date("time"))
    telemetry.write_raw(raw, f"{path}/stream=a/batch_id=0")
    telemetry.write_raw(raw.unionByName(bad), f"{path}/stream=b/batch_id=0")
    back = telemetry.read_raw(spark, path)
    assert back.count() == 301
    assert table(pipeline.expire(back, days=1)) == [(date(2024, 5, 1),)]
    assert pipeline.expire(back, days=1, as_of=F.lit("2024-05-02").cast("timestamp")).count() == 0
    assert landing.within_retention(back, days=1).count() == 2 * 51 + 1
    assert panels.recent(back, hours=24).where("time < '2900-01-01'").count() == 2 * 51
    assert telemetry.drop_days(spark, path, "2024-05-03") == ["date=2024-05-01", "date=2024-05-02"]
    assert telemetry.read_raw(spark, path).where("date < '2024-05-03'").count() == 0


def test_time_range_prunes_days(spark, frame):
    path = work_folder(spark, "prune")
    telemetry.write_raw(raw_frame(frame), path)
    df = panels.between_time(telemetry.read_raw(spark, path), "2024-05-02 00:10:00", "2024-05-02 00:20:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(time" in plan
    assert df.count() == 10


def test_recent_rows_prune_days_and_match(spark, frame):
    path = work_folder(spark, "recent")
    raw = raw_frame(frame)
    telemetry.write_raw(raw, path)
    stored = telemetry.read_raw(spark, path)
    df = panels.recent(stored, hours=24)
    assert df.count() == panels.recent(raw.drop("date"), hours=24).count() == 51
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date" in scan and "Subquery" in scan


def test_the_typed_layer_looks_for_copies_among_typed_rows(spark, frame, monkeypatch):
    # The maps would otherwise be shuffled, and taken apart again for the sample of the ranges.
    given, dedupe = [], landing.dedupe
    monkeypatch.setattr(landing, "dedupe", lambda rows, *key: (given.append(rows.columns), dedupe(rows, *key))[1])
    raw = raw_frame(frame)
    path = work_folder(spark, "typed")
    pipeline.write_silver(raw.unionByName(raw), path)
    assert given and not {"value", "metadata", "dimensions"} & set(given[0])
    assert spark.read.parquet(path).count() == dedupe(raw.unionByName(raw)).count()


def test_silver_scan_reads_needed_columns_only(spark, frame):
    from millwatt.operators import staging

    path = work_folder(spark, "silver")
    pipeline.write_silver(raw_frame(frame), path)
    stg = spark.read.parquet(path)
    assert set(staging.telemetry(raw_frame(frame)).columns) < set(stg.columns)
    plan = panels.power_by_type(stg)._jdf.queryExecution().optimizedPlan().toString()
    physical = panels.power_by_type(stg)._jdf.queryExecution().executedPlan().toString()
    assert "ahu_supply_temp" not in physical.split("Location")[0] and "total_power" in plan


def test_json_messages(spark, frame):
    good = {"deviceId": "d", "source": "bms", "equipmentType": "AHU", "building": "b", "ts_utc": 5,
            "value": {"a": 1.5, "b": "x"}, "metadata": {"msgId": "1"}}
    messages = frame([(json.dumps(good), "t", 7), ("broken", "t", 8)], "value string, topic string, offset bigint")
    got = telemetry.decode_json(messages)
    assert table(got, "deviceId", "value") == [(None, None), ("d", {"a": "1.5", "b": "x"})]
    bad = landing.quarantined(landing.from_text_members(got))
    assert table(bad, "message", "topic", "offset", "reason") == [
        ("broken", "t", 8, "missing deviceId"), (json.dumps(good), "t", 7, "missing metadata deviceId")
    ]


def test_event_files_as_batch(spark, frame):
    path = work_folder(spark, "events")
    frame([("d", "bms", "AHU", "b", 1, {"a": 1.0}, {"k": "v"})], schemas.TELEMETRY_EVENT).write.parquet(path)
    assert telemetry.read_event_files(spark, path).first().value == {"a": 1.0}


def test_topic_reader_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        telemetry.read_topics(spark, "localhost:1")
