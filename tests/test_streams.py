"""Streams over folders of files, fed in several batches and compared with the batch operators."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows as table
from pyspark.sql import functions as F

from millwatt import schemas
from millwatt.operators import signals
from millwatt.session import work_folder
from millwatt.sources import telemetry
from millwatt.streaming import energy, ingest, lateness, runs, windows

START = datetime(2024, 5, 1)
NOW = {"availableNow": True}


@pytest.fixture
def folder(spark):
    return lambda name: work_folder(spark, name)


def feed(frame, path, schema, rows):
    frame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_landing_keeps_late_rows_and_sets_bad_ones_aside(spark, frame, folder):
    source, raw, bad, state = (folder(n) for n in ("source", "raw", "bad", "state"))
    schema = schemas.TELEMETRY_TEXT_EVENT

    def event(device, ts, value):
        return (device, "bms", "AHU", "b", ts, value, {"deviceId": device, "source": "bms"})

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        ingest.start(stream, raw, bad, state, NOW).awaitTermination()

    feed(frame, source, schema, [event("a", 10**12, {"x": "1"}), event(None, 1, {"x": "1"})])
    run()
    feed(frame, source, schema, [event("b", 5, {"x": "bad", "y": "2"})])
    run()
    run()
    assert table(spark.read.parquet(raw), "device_id", "value") == [("a", {"x": 1.0}), ("b", {"y": 2.0})]
    assert telemetry.read_raw(spark, raw).columns[-1] == "date" and telemetry.read_raw(spark, raw).count() == 2
    assert table(spark.read.parquet(bad), "reason") == [("bad value: x",), ("missing deviceId",)]


def test_typed_event_files_land(spark, frame, folder):
    source, raw, bad, state = (folder(n) for n in ("source", "raw", "bad", "state"))
    feed(frame, source, schemas.TELEMETRY_EVENT, [("a", "bms", "AHU", "b", 1500, {"x": 0.1}, {"deviceId": "a"})])
    ingest.start(telemetry.read_event_files(spark, source, streaming=True), raw, bad, state, NOW).awaitTermination()
    got = spark.read.parquet(raw).first()
    assert got.value == {"x": 0.1} and got.time == datetime(1970, 1, 1, 0, 0, 1, 500000)


WIRE = "device_id string, time timestamp, value map<string,double>"


def test_windows_close_after_the_delay_and_match_the_batch(spark, frame, folder):
    source, out, state = folder("source"), folder("out"), folder("state")
    rows = [("d", START + timedelta(seconds=15 * i), {"totalPower": float(i)}) for i in range(40)]

    def run():
        rolled = windows.tumbling(spark.readStream.schema(WIRE).parquet(source))
        query = rolled.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query.trigger(**NOW).start().awaitTermination()

    feed(frame, source, WIRE, rows[:20])
    run()
    feed(frame, source, WIRE, rows[20:])
    run()
    # Last reading 00:09:45, minus 30 s: windows up to 00:09 are complete.
    batch = windows.tumbling(frame(rows, WIRE)).where(F.col("window_end") <= F.lit(START + timedelta(minutes=9)))
    assert table(spark.read.parquet(out)) == table(batch)


def test_duplicates_within_and_across_batches(spark, frame, folder):
    source, out, state = folder("source"), folder("out"), folder("state")
    schema = "msg_id string, time timestamp, arrival bigint"

    def run():
        unique = windows.deduplicated(spark.readStream.schema(schema).parquet(source))
        query = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query.trigger(**NOW).start().awaitTermination()

    feed(frame, source, schema, [("a", START, i) for i in range(50)] + [("b", START, 50)])
    run()
    feed(frame, source, schema, [("a", START, 51), ("c", START + timedelta(seconds=5), 52)])
    run()
    assert table(spark.read.parquet(out), "msg_id") == [("a",), ("b",), ("c",)]


READING = "device_id string, time timestamp, msg_id string, total_power double"


def test_energy_over_batches_equals_one_batch(spark, frame, folder):
    source, out, state = folder("source"), folder("out"), folder("state")
    rows = [
        (f"d{i % 3}", START + timedelta(seconds=37 * i), str(i), None if i % 11 == 0 else float(i % 7)) for i in range(90)
    ]

    def run():
        energy.start(spark.readStream.schema(READING).parquet(source), out, state, NOW).awaitTermination()

    for part in (rows[:30], rows[30:45], rows[45:]):
        feed(frame, source, READING, part)
        run()
    feed(frame, source, READING, [("d0", START, "late", 99.0), ("d9", START, "new", 1.0)])
    run()
    got = spark.read.parquet(f"{out}/totals")
    whole = signals.integrate_energy(frame([*rows, ("d9", START, "new", 1.0)], READING))
    assert table(got, "device_id", "msg_id", "total_kwh") == table(whole, "device_id", "msg_id", "total_kwh")
    assert table(spark.read.parquet(f"{out}/late"), "msg_id") == [("late",)]
    assert sorted(runs.versions(spark, out)) == [2, 3]


def test_energy_goes_on_with_a_new_checkpoint(spark, frame, folder):
    source, out = folder("source"), folder("out")
    rows = [("d", START + timedelta(minutes=6 * i), str(i), 10.0) for i in range(21)]

    def run(state):
        energy.start(spark.readStream.schema(READING).parquet(source), out, state, NOW).awaitTermination()

    feed(frame, source, READING, rows[:11])
    run(folder("first"))
    feed(frame, source, READING, [*rows[11:], ("d", rows[10][1], "a-later-id", 10.0)])
    run(folder("second"))
    got = {r.msg_id: float(r.total_kwh) for r in spark.read.parquet(f"{out}/totals").collect()}
    # Ten kilowatts for two hours; the second run sees the first one's files again and sets them aside.
    assert got["10"] == 10.0 and got["20"] == 20.0 and got["a-later-id"] == 10.0
    assert spark.read.parquet(f"{out}/late").count() == 11 and spark.read.parquet(f"{out}/totals").count() == 22


def test_landing_with_a_new_checkpoint_keeps_earlier_rows(spark, frame, folder):
    raw, bad = folder("raw"), folder("bad")
    for name in ("a", "b"):
        source = folder("source")
        good = (name, "bms", "AHU", "b", 1000, {"x": 1.0}, {"deviceId": name})
        feed(frame, source, schemas.TELEMETRY_EVENT, [good, (name, "bms", "AHU", "b", None, {}, {})])
        ingest.start(telemetry.read_event_files(spark, source, streaming=True), raw, bad, folder("state"), NOW).awaitTermination()
    assert table(telemetry.read_raw(spark, raw), "device_id") == [("a",), ("b",)]
    assert table(spark.read.parquet(bad), "deviceId", "reason") == [("a", "missing ts_utc"), ("b", "missing ts_utc")]
    ids = [r.id for r in spark.read.parquet(raw).selectExpr("metadata['msgId'] as id").collect()]
    assert None not in ids and len(set(ids)) == 2


CHANGE = "op string, before struct<id:int>, after struct<id:int>, source struct<ts_ms:bigint,lsn:bigint>"


def test_changes_with_a_new_checkpoint_and_three_batches(spark, frame, folder):
    from millwatt.operators import changes
    from millwatt.sources.changelog import ChangeTable

    source, first, second = folder("source"), folder("first"), folder("second")
    kept = ChangeTable(spark, folder("table"), ["id"], "id int")

    def run(state):
        stream = changes.unwrap(spark.readStream.schema(CHANGE).parquet(source))
        stream.writeStream.foreachBatch(kept.sink(state)).option("checkpointLocation", state).trigger(**NOW).start().awaitTermination()

    for at in range(3):
        feed(frame, source, CHANGE, [("c", None, (at,), (at, at)), ("d", (at - 1,), None, (at, 100 + at))])
        run(first)
    kept.compact()
    kept.clean()
    source = folder("again")
    feed(frame, source, CHANGE, [("c", None, (50,), (50, 50))])
    run(second)
    assert table(kept.current(), "id") == [(2,), (50,)]


def test_late_rows_over_batches_equal_one_batch(spark, frame, folder):
    source, out, state = folder("source"), folder("out"), folder("state")
    schema = "arrival bigint, time timestamp"
    rows = [(3 * i, START + timedelta(seconds=20 * i - (90 if i % 7 == 3 else 0))) for i in range(40)]
    for part in (rows[:13], rows[13:14], rows[14:]):
        feed(frame, source, schema, part)
        lateness.start(spark.readStream.schema(schema).parquet(source), out, state, trigger=NOW).awaitTermination()
    got = spark.read.schema("arrival bigint, time timestamp, newest timestamp").parquet(f"{out}/late").select("arrival", "time", "newest")
    whole = signals.late_rows(frame(rows, schema), "arrival")
    assert table(got) == table(whole) and got.count() >= 5


def test_counters_in_the_state_store_over_batches_a_restart_and_an_idle_device(spark, frame, folder):
    from millwatt.streaming import counters

    source, out, state = folder("source"), folder("out"), folder("state")
    rng = random.Random(8)
    devices = ["a"] * 4 + ["b"] * 2
    rows = [(rng.choice(devices), START + timedelta(minutes=3 * i), f"{i:03d}", rng.choice([None, 0.125, 10.0])) for i in range(60)]
    rows += [("silent", START + timedelta(minutes=1), "000", 3.0), ("a", START, None, 2.0)]
    rows.sort(key=lambda r: (r[1], r[2] or ""))
    end = ("a", START + timedelta(hours=9), "zzz", 1.0)
    # Three batches, each a run of its own that goes on from the checkpoint; one reading comes again, and time moves on at last.
    for part in (rows[:20], rows[20:45], [*rows[45:], rows[0]], [end], [end[:2] + ("zzzz", 1.0)]):
        rng.shuffle(part)
        feed(frame, source, READING, part)
        counters.start(spark.readStream.schema(READING).parquet(source), out, state, "4 hours", "1 hour", NOW).awaitTermination()
    got = spark.read.parquet(out)
    whole = signals.integrate_energy(frame([*rows, end, end[:2] + ("zzzz", 1.0)], READING).withColumn("total_power", F.col("total_power").cast("decimal(28,12)")))
    columns = ["device_id", "time", "msg_id", "total_kwh"]
    assert table(got.where("kind = 'total'"), *columns) == table(whole, *columns)
    idle = [tuple(r) for r in got.where("kind = 'idle'").select("device_id", "time").collect()]
    assert ("silent", START + timedelta(minutes=1)) in idle and sorted(d for d, _ in idle) == sorted(set(d for d, _ in idle))
    # The repeated reading is behind the watermark or behind the last one counted; either way it counts once.
    assert got.where("kind = 'late'").count() <= 1


def test_replays_are_dropped_however_late(spark, frame, folder):
    from millwatt.streaming.replays import ReplayIndex

    raw, bad, index = folder("raw"), folder("bad"), ReplayIndex(spark, folder("ids"))
    schema = schemas.TELEMETRY_EVENT

    def event(number, days=0):
        return ("d", "bms", "AHU", "b", (1_700_000_000 + 86_400 * days) * 1000, {"x": float(number)}, {"deviceId": "d", "msgId": f"m{number}"})

    def run(source, state):
        stream = spark.readStream.schema(schema).parquet(source)
        ingest.start(stream, raw, bad, state, NOW, index=index).awaitTermination()

    def landed():
        return sorted(r[0] for r in telemetry.read_raw(spark, raw).selectExpr("metadata['msgId']").collect())

    source, state = folder("source"), folder("state")
    feed(frame, source, schema, [event(1), event(2), event(2), event(3, 1)])
    run(source, state)
    # A month later the same messages come again, with new ones, one of them without an id.
    feed(frame, source, schema, [event(1), event(9, 30), event(3, 1), event(3, 1), ("e", "bms", "AHU", "b", 5, {}, {"deviceId": "e"})])
    run(source, state)
    assert [i for i in landed() if i.startswith("m")] == ["m1", "m2", "m3", "m9"] and len(landed()) == 5
    # A batch that is run again finds what it found the first time.
    again = telemetry.read_raw(spark, raw).where("metadata['msgId'] in ('m1', 'm9')")
    stream = runs.stream_id(spark, state)
    assert sorted(r[0] for r in index.fresh(again, stream, 1).selectExpr("metadata['msgId']").collect()) == ["m9"]
    assert index.fresh(again, stream, 0).count() == 2 and index.fresh(again, stream, 2).count() == 0
    # A new checkpoint reads everything again.
    run(source, folder("other"))
    assert len(landed()) == 5
    assert index.forget("2023-12-01") == ["1970-01-01", "2023-11-14", "2023-11-15"] and index.ids().count() == 1


def _indexed(spark, folder, ids):
    """An index in which the days and ids of one batch are."""
    from millwatt.streaming.replays import ReplayIndex

    index = ReplayIndex(spark, folder)
    if ids:
        index.add(spark.createDataFrame(ids, "date date, metadata map<string,string>"), "before", 0)
    return index


def _raw(spark, numbered):
    """Raw rows of pairs of an id and a minute from the start of the first day."""
    times = [(START + timedelta(minutes=m), i, n) for n, (i, m) in enumerate(numbered)]
    made = [(t, {"x": float(n)}, {"name": "d"}, {"msgId": i}, "d", "bms", t.date()) for t, i, n in times]
    return spark.createDataFrame(made, schemas.RAW_TELEMETRY)


def test_whole_rows_stay_where_they_are_when_all_or_none_of_a_batch_is_new(spark, folder):
    raw = _raw(spark, [(f"m{i}", i) for i in range(50)] + [(None, 3), (None, 3)])

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    new = _indexed(spark, folder("new"), []).fresh(raw, "s", 0)
    assert new.count() == 52 and exchanges(new) == 0
    again = _indexed(spark, folder("again"), [(r.date, r.metadata) for r in raw.collect()]).fresh(raw, "s", 0)
    assert [r.metadata["msgId"] for r in again.collect()] == [None, None] and exchanges(again) == 0


@pytest.mark.parametrize("few", [100_000, 0])
@pytest.mark.parametrize("known", [0, 5, 90])
def test_replays_mixed_with_new_messages(spark, folder, monkeypatch, few, known):
    from millwatt.streaming import replays

    monkeypatch.setattr(replays, "FEW", few)  # 0: rows meet even short lists by a shuffle
    day = 24 * 60
    numbered = [(f"m{i}", i % 7 * day + i) for i in range(100)] + [(f"m{i}", i % 7 * day + i) for i in range(0, 100, 9)]
    # The same ids on later and on earlier days, and rows without an id.
    numbered += [(f"m{i}", i % 7 * day + i + day * (1 if i % 2 else -1)) for i in range(0, 100, 13)] + [(None, 5), (None, 5)]
    raw = _raw(spark, numbered)
    landed = {(i, START + timedelta(minutes=m)) for i, m in numbered[:known]}
    index = _indexed(spark, folder("ids"), [(t.date(), {"msgId": i}) for i, t in landed])
    days, want = {(i, t.date()) for i, t in landed}, {}
    for i, t in ((i, START + timedelta(minutes=m)) for i, m in numbered if i):
        if (i, t.date()) not in days:
            want[i] = min(t, want.get(i, t))
    got = index.fresh(raw, "s", 0).collect()
    named = [(r.metadata["msgId"], r.time) for r in got if r.metadata["msgId"]]
    assert sorted(named) == sorted(want.items()) and len(got) == len(named) + 2
    index.add(raw, "s", 0)
    assert index.ids().where("stream = 's'").count() == len(numbered) and not list(Path(index.folder).glob("_judged/stream=s/*"))


def test_a_device_that_falls_silent_is_told_once(spark, frame, folder):
    from millwatt.streaming import outages

    source, out, state = folder("source"), folder("out"), folder("state")
    schema = "device_id string, equipment_type string, time timestamp"
    steady = [("a", "AHU", START + timedelta(minutes=4 * i)) for i in range(60)]
    broken = [("b", "CNC", START + timedelta(minutes=m)) for m in (0, 5, 9, 40, 41, 100)]
    rows = sorted(steady + broken, key=lambda r: r[2])
    for part in (rows[:20], rows[20:45], rows[45:]):
        feed(frame, source, schema, part)
        outages.start(spark.readStream.schema(schema).parquet(source), out, state, "10 minutes", trigger=NOW).awaitTermination()
    got = spark.read.parquet(out)
    want = outages.sessions(frame(rows, schema), "10 minutes").where("device_id = 'b'")
    assert table(got) == table(want) and [r.readings for r in want.orderBy("first_time").collect()] == [3, 2, 1]
    assert table(outages.by_type(got), "equipment_type", "silences", "devices", "longest_minutes") == [("CNC", 3, 1, 9.0)]
    assert outages.by_type(got, "2024-05-01 00:19:00").count() == 0
