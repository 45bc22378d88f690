"""The raw table beside its landing, tables by bucket, and the incremental build."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows as table
from pyspark.sql import functions as F

from millwatt import schemas
from millwatt.operators import changes, dims, facts, landing, rollups, signals, staging
from millwatt.plans import upkeep
from millwatt.plans.daily import DailyBuild
from millwatt.session import work_folder
from millwatt.sources import telemetry
from millwatt.sources.files import folders
from millwatt.sources.keyed import HistoryTable, KeyedTable
from millwatt.sources.parts import PartTable
from millwatt.sources.rawtable import RawTable

START = datetime(2024, 5, 1)


def reading(device, hours, number, kind="CNC", energy=None, power=5.0):
    ts = int((START + timedelta(hours=hours) - datetime(1970, 1, 1)).total_seconds() * 1000)
    source = "ems" if kind == "CNC" else "bms"
    meta = {"deviceId": device, "source": source, "msgId": f"m{number:05d}", "topic": "t", "schema_ver": "v1"}
    value = {"totalPower": power, "totalEnergy": float(number if energy is None else energy)} if kind == "CNC" else {"Supply_Temp": 14.0, "Return_Temp": 20.0}
    return (device, source, kind, "Building-Alpha", ts, value, meta)


@pytest.fixture
def land(spark, frame):
    def put(root, batch, events, stream="a"):
        raw = landing.land(frame(events, schemas.TELEMETRY_EVENT))
        raw.write.mode("overwrite").partitionBy("date").parquet(f"{root}/stream={stream}/batch_id={batch}")
        return raw

    return put


def ids(df):
    return sorted(r[0] for r in df.select(F.col("metadata")["msgId"]).collect())


def test_landing_goes_on_beside_compaction(spark, land):
    root = work_folder(spark, "raw")
    raw = RawTable(spark, root)
    assert raw.read().count() == 0 and raw.compact("2999-01-01") == [] and raw.day_totals() == {}
    days = [reading("d", 24 * d, d) for d in range(10)]
    land(root, 0, days)
    assert upkeep.settle(spark, root) == ["2024-05-01", "2024-05-02"]
    assert ids(telemetry.read_raw(spark, root)) == [f"m{d:05d}" for d in range(10)]
    totals = raw.day_totals()
    # A late reading for a settled day, and the next batch of another stream with the same number.
    land(root, 1, [reading("d", 1, 100), reading("d", 24 * 9 + 1, 101)])
    land(root, 0, [reading("e", 2, 102)], "b")
    want = [f"m{d:05d}" for d in [*range(10), 100, 101, 102]]
    assert ids(telemetry.read_raw(spark, root)) == want
    assert {d for d, n in raw.day_totals().items() if n != totals[d]} == {"2024-05-01", "2024-05-10"}
    kept = raw.settled.parts()["2024-05-02"]
    assert upkeep.settle(spark, root) == ["2024-05-01"] and raw.settled.parts()["2024-05-02"] == kept
    assert len(raw.clean()) == 4 and ids(telemetry.read_raw(spark, root)) == want
    totals = raw.day_totals()
    # The newest batch of a stream is run again and brings back what is settled: it does not count twice.
    land(root, 1, [reading("d", 1, 100), reading("d", 24 * 9 + 1, 101)])
    assert ids(telemetry.read_raw(spark, root)) == want and raw.day_totals() == totals
    # A batch that was not written to its end is not read.
    land(root, 2, [reading("d", 24 * 9, 200)])
    (mark,) = folders(spark, f"{root}/stream=a/batch_id=2/_SUCCESS")
    telemetry.delete_folder(spark, mark)
    assert ids(raw.read()) == want
    # Only the days asked for are read.
    assert ids(raw.read(["2024-05-01"])) == ["m00000", "m00100", "m00102"]
    files = raw.read(["2024-05-01"]).inputFiles()
    assert files and all("2024-05-01" in f for f in files)
    pruned = raw.read().where(F.col("date") >= F.lit("2024-05-09").cast("date"))
    assert ids(pruned) == ["m00008", "m00009", "m00101"]
    assert upkeep.retire(spark, root, days=8) == ["date=2024-05-01"]
    assert ids(telemetry.read_raw(spark, root)) == [i for i in want if i not in ("m00000", "m00100", "m00102")]


def test_parts_are_checked(spark, frame):
    folder = work_folder(spark, "parts")
    parts = PartTable(spark, folder, "x int", {"n": "1"})
    parts.replace(frame([(1, "a"), (2, "b")], "x int, table_part string"), ["a", "b"])
    with pytest.raises(ValueError, match="not replaced"):
        parts.replace(frame([(3, "b")], "x int, table_part string"), ["a"])
    with pytest.raises(ValueError, match="was made with"):
        PartTable(spark, folder, "x int", {"n": "2"})
    parts.replace(frame([], "x int, table_part string"), ["a"])
    assert table(parts.read()) == [(2,)] and len(parts.clean()) == 1 and table(parts.read(["a", "b"])) == [(2,)]


LOG = "id int, status string, __op string, __source_ts_ms bigint, __lsn bigint, __deleted string"


def test_keyed_table_rewrites_touched_buckets_only(spark, frame):
    rng = random.Random(1)
    kept = KeyedTable(spark, work_folder(spark, "keyed"), ["id"], "id int, status string", buckets=8)
    log, lsn = [], 0
    for batch in range(4):
        rows = []
        for _ in range(60 if batch == 0 else 4):
            lsn += 1
            gone = rng.random() < 0.2
            rows.append((rng.randrange(40), f"s{lsn}", "d" if gone else "u", rng.randrange(100), lsn, str(gone).lower()))
        log += rows
        before = kept.table.parts()
        written = kept.merge(frame(rows, LOG), batch, "s")
        after = kept.table.parts()
        assert {b for b in after if before.get(b) != after[b]} <= set(written)
        assert kept.merge(frame(rows, LOG), batch, "s") == [] and kept.table.parts() == after
        want = changes.current(frame(log, LOG), ["id"])
        assert table(kept.current()) == table(want)
        assert batch == 0 or len(written) < 8
    kept.table.clean()
    assert table(kept.current(keep_deleted=True), "id") == table(changes.current(frame(log, LOG), ["id"], keep_deleted=True), "id")


@pytest.mark.parametrize("max_rows", [3, 1_000_000])
def test_history_from_batches_is_that_of_the_whole_log(spark, frame, max_rows):
    rng = random.Random(max_rows)
    schema = "id int, status string, qty int, at timestamp, serial int"
    log = [(rng.randrange(6), rng.choice("ab"), rng.randrange(2), START + timedelta(hours=rng.randrange(40)), i) for i in range(80)]
    kept = HistoryTable(
        spark, work_folder(spark, "history"), ["id"], ["status", "qty"], "at", ["serial"], schema, buckets=4, max_rows=max_rows
    )
    rng.shuffle(log)
    # One batch comes twice, under another number the second time.
    for number, part in enumerate([log[:40], log[40:41], log[41:70], log[41:70], log[70:]]):
        kept.merge(frame(part, schema), number)
    want = changes.history(frame(log, schema), ["id"], ["status", "qty"], "at", ["serial"])
    columns = ["id", "status", "qty", "valid_from", "valid_to", "is_current"]
    assert table(kept.intervals(), *columns) == table(want, *columns)


def test_history_looks_stored_rows_up_by_key_unsorted(spark, frame):
    schema = "id int, status string, at timestamp, serial int"
    kept = HistoryTable(spark, work_folder(spark, "history"), ["id"], ["status"], "at", ["serial"], schema, buckets=2)
    kept.merge(frame([(i, "a", START, i) for i in range(8)], schema), 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = kept._merged(kept.table.read(), kept._prepared(frame([(3, "b", START + timedelta(hours=1), 9)], schema)))
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plan and merged.count() == 9


def test_partitions_are_bounded(spark):
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


@pytest.fixture
def plant(spark, frame):
    master = frame([(1, "A-01", "AHU", "Building-Alpha", "BA", "E-1", "B-1", "1", None, None, None, None)], schemas.MACHINE_MASTER)
    full = f"{schemas.ERP_TABLES['machines']}, {schemas.CHANGE_COLUMNS}"
    make = lambda rated: frame([(m, "CNC", "Building-Alpha", m, Decimal(rated), True, START, "c", 1, 1, "false") for m in ("M-1", "M-2")], full)
    return master, make


def test_incremental_build_equals_a_full_one(spark, land, plant):
    master, machines = plant
    root, folder = work_folder(spark, "raw"), work_folder(spark, "marts")
    raw, marts = RawTable(spark, root), DailyBuild(spark, folder)
    rng = random.Random(3)
    events = [reading(rng.choice(["M-1", "M-1", "M-2"]), rng.randrange(24 * 4) + i / 100, i, energy=rng.randrange(50), power=rng.choice([0.5, 7.25])) for i in range(90)]
    events += [reading("M-2", 24 * 8 + 3, 95), reading("B-1", 5, 96, "AHU")]
    late = [e for e in events if e[4] // 86_400_000 == int(START.timestamp()) // 86_400 + 2 and e[6]["msgId"] > "m00040"]
    # With a copy of a message, and a device that is silent for days.
    batches = [[e for e in events if e not in late] + events[:3], late, [reading("M-1", 24 * 7, 97), reading("B-1", 24 * 7, 98, "AHU")]]
    assert late
    built = []
    for number, batch in enumerate(batches):
        land(root, number, batch)
        built.append(marts.run(raw, master, machines(30), max_rows=4))
        upkeep.settle(spark, root, days=3)
        raw.clean()
        assert marts.changed_days(raw, marts.manifest.entries()["dimensions"]["digest"]) == ([], [])
        stg = staging.telemetry(landing.dedupe(raw.read()))
        days, clock, machine = dims.calendar(spark), dims.minutes(spark), dims.machine(staging.machines(machines(30)))
        want = facts.energy(stg, machine, days, clock)
        assert table(marts.energy().select(*want.columns)) == table(want)
        hours = rollups.by_hour(rollups.by_minute(want))
        assert table(marts.hours().select(*hours.columns)) == table(hours)
        whole = signals.accumulate_work(stg.where("source = 'ems'").select("device_id", "time", "msg_id", "total_power"))
        assert table(marts.totals(), "msg_id", "total_work") == table(whole, "msg_id", "total_work")
    hvac = facts.hvac(staging.ahu(stg), staging.chiller(stg), dims.equipment(master), days, clock)
    assert table(marts.read("fact_hvac_reading").select(*hvac.columns)) == table(hvac)
    assert built[1] == ["2024-05-03"] and built[2] == ["2024-05-08"]
    day = table(marts.totals(["2024-05-03"]), "msg_id", "total_work")
    assert day == table(whole.where("to_date(time) = '2024-05-03'"), "msg_id", "total_work")
    # Days that were not built again keep their folders, and only those of the newest build's list are left.
    assert marts.manifest.entries()["day:machine_readings"]["2024-05-01"].split("/")[-2] == "build=0"
    assert marts.clean() and table(marts.totals(), "msg_id", "total_work") == table(whole, "msg_id", "total_work")
    # Days that the raw table gives up go; a changed machine builds all days anew.
    raw.retire("2024-05-02")
    assert marts.run(raw, master, machines(30)) == [] and marts.read("telemetry").where("date < '2024-05-02'").count() == 0
    assert len(marts.run(raw, master, machines(35))) == len(raw.day_totals())
