"""The rules where a plain translation goes wrong; numbers follow the survey's list."""

from __future__ import annotations

import json
import random
import struct
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows as table
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions import clock, labels, maps, registers
from millwatt.functions.numeric import half_up, ratio
from millwatt.operators import dims, facts, landing, quality, registry, rollups, signals, staging
from millwatt.plans import analytics, panels

RAW = "time timestamp, value map<string,double>, dimensions map<string,string>, metadata map<string,string>, device_id string, source string"
NOON = datetime(2024, 5, 1, 12, 0)


def raw_row(device, kind, value, time=NOON, building="Building-Alpha", msg="1", source="bms"):
    dimensions = {"building": building, "equipmentType": kind, "name": device}
    metadata = {"deviceId": device, "source": source, "msgId": msg, "topic": "t", "schema_ver": "v1"}
    return (time, value, dimensions, metadata, device, source)


@pytest.fixture
def raw(frame):
    return lambda *rows: frame(list(rows), RAW)


def test_t1_t3_air_bands_and_default_delta(raw):
    stg = staging.telemetry(
        raw(
            raw_row("a", "AHU", {"Return_Temp": 20.0}),
            raw_row("b", "AHU", {"Supply_Temp": 10.0, "Return_Temp": 25.5}),
            raw_row("c", "AHU", {"Supply_Temp": 20.0}),
            raw_row("d", "AHU", {"Supply_Temp": 20.01, "Return_Temp": 20.0}),
        )
    )
    got = {r.device_name: r for r in staging.ahu(stg).collect()}
    assert {k: r.supply_temp_status for k, r in got.items()} == {"a": "MISSING", "b": "OK", "c": "OK", "d": "WARN"}
    assert got["a"].delta_temp == 0 and got["a"].delta_temp_nullable is None
    assert got["b"].delta_temp == Decimal("15.5") and got["d"].delta_temp_nullable == Decimal("-0.01")


def test_t2_t3_chiller_percent(raw):
    key = "Chilled_Water_{}_Temp"
    stg = staging.telemetry(
        raw(
            raw_row("zero", "Chillers", {key.format("Supply"): 0.0, key.format("Return"): 9.0}),
            raw_row("none", "Chillers", {key.format("Return"): 9.0}),
            raw_row("good", "Chillers", {key.format("Supply"): 8.0, key.format("Return"): 9.0}),
            raw_row("edge", "Chillers", {key.format("Supply"): 12.0, key.format("Return"): 13.0}),
        )
    )
    got = {r.device_name: r for r in staging.chiller(stg).collect()}
    assert got["zero"].delta_pct is None and got["none"].delta_pct is None
    assert got["good"].delta_pct == Decimal("12.50") and got["edge"].delta_pct == Decimal("8.33")
    assert [got[k].supply_temp_status for k in ("zero", "none", "good", "edge")] == ["WARN", "MISSING", "OK", "OK"]


def test_t4_keys_survive_a_rebuild(spark, frame):
    machines = [(f"m{i}", "CNC", "Building-Beta", f"m{i}", Decimal("35.00"), True) for i in range(20)]
    schema = "machine_id string, machine_type string, building string, energy_tag string, rated_power_kw decimal(8,2), is_active boolean"
    before = {r.machine_id: r.machine_key for r in dims.machine(frame(machines, schema)).collect()}
    after = {r.machine_id: r.machine_key for r in dims.machine(frame(machines[::-2], schema)).collect()}
    assert len(set(before.values())) == 20
    assert all(before[k] == v for k, v in after.items())


def energy_models(spark, frame, readings):
    stg = staging.telemetry(frame(readings, RAW))
    machines = frame(
        [("m", "CNC", "Building-Beta", "BB", "m", 1), ("n", "CNC", "Building-Beta", "BB", "n", 2)],
        "machine_id string, machine_type string, building string, building_code string, energy_tag string, machine_key bigint",
    )
    return stg, machines, dims.calendar(spark), dims.minutes(spark)


def test_t5_t10_counter_reset_ties_and_calendar(spark, frame):
    def reading(device, minute, energy, msg, day=1):
        return raw_row(
            device, "CNC", {"totalPower": 5.0, "totalEnergy": energy}, datetime(2024, 5, day, 12, minute), msg=msg, source="ems"
        )

    rows = [
        reading("m", 0, 10.0, "1"), reading("m", 1, 12.0, "2"), reading("m", 1, 13.0, "3"), reading("m", 2, 3.0, "4"),
        reading("unknown", 0, 1.0, "5"),
    ]
    late = raw_row("m", "CNC", {"totalPower": 1.0, "totalEnergy": 99.0}, datetime(2027, 1, 1), msg="6", source="ems")
    models = energy_models(spark, frame, [*rows, late])
    got = {r.msg_id: r for r in facts.energy(*models).collect()}
    assert sorted(got) == ["1", "2", "3", "4"]
    assert [got[m].delta_kwh for m in "1234"] == [None, 2, 1, -10]
    assert [got[m].delta_kwh_reset_safe for m in "1234"] == [None, 2, 1, 3]
    cut = {r.msg_id: r.delta_kwh for r in facts.energy(*models, max_rows=1).collect()}
    assert [cut[m] for m in "1234"] == [None, 2, 1, -10]
    assert facts.outside_calendar(models[0], "time", models[2]).first()[0] == 1


def test_t14_energy_modes(spark, frame):
    rows = [
        raw_row("m", "CNC", {"totalEnergy": 4.0}, NOON + timedelta(hours=i), msg=str(i), source="ems") for i in range(3)
    ]
    models = energy_models(spark, frame, rows)
    bucket = facts.energy(*models, energy_mode="bucket")
    assert [r.delta_kwh for r in bucket.collect()] == [4, 4, 4]
    with pytest.raises(ValueError):
        facts.energy(*models, energy_mode="guess")


def test_t6_to_t8_calendar(spark):
    days = {str(r.date_id): r for r in dims.calendar(spark).collect()}
    assert len(days) == 1096
    sunday = days["2024-09-01"]
    assert (sunday.day_of_week, sunday.day_of_week_iso, sunday.day_name, sunday.month_name) == (0, 7, "Sunday", "September")
    assert [days[f"2024-{m:02d}-01"].quarter_of_year for m in range(1, 13)] == [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3
    assert days["2024-12-30"].week_of_year == 1


def test_t9_minutes(spark):
    got = {r.time_key: r for r in dims.minutes(spark).collect()}
    assert len(got) == 1440
    assert (got[719].hour_of_day, got[719].minute_of_hour, got[719].time_label, got[719].time_of_day) == (11, 59, "11:59", "morning")
    assert [got[h * 60].time_of_day for h in (5, 6, 12, 17, 18, 21, 22)] == [
        "night", "morning", "afternoon", "afternoon", "evening", "evening", "night"
    ]


def test_t12_dimension_reads_latest_rows(frame):
    rows = [
        ("m", "CNC", "Building-Gamma", "m", Decimal(1), True, 5),
        ("m", "CNC", "Building-Gamma", "m", Decimal(2), True, 9),
        ("m", "CNC", "Building-Gamma", "m", Decimal(3), True, None),
        ("x", "LATHE", "Building-Gamma", "x", Decimal(3), True, 1),
    ]
    schema = "machine_id string, machine_type string, building string, energy_tag string, rated_power_kw decimal(8,2), is_active boolean, __source_ts_ms bigint"
    got = dims.machine(staging.machines(frame(rows, schema))).collect()
    assert [(r.machine_id, r.rated_power_kw, r.building_code, r.machine_type_order) for r in got] == [("m", 2, "BG", 2)]


def test_t13_run_and_state_names(frame):
    run = frame(
        [(7, 1, "m", 5, 2, NOON, NOON + timedelta(seconds=90))],
        "run_id int, work_order_id int, machine_id string, good_qty int, scrap_qty int, started_at timestamp, ended_at timestamp",
    )
    got = staging.production_runs(run).first()
    assert (got.id, got.total_qty, got.start_time) == (7, 7, NOON)
    minutes = staging.production_runs(run).select(clock.minutes_between(F.col("end_time"), F.col("start_time"))).first()[0]
    assert minutes == 1.5


def test_open_state_is_closed_by_the_next(frame):
    states = frame(
        [(1, "m", "RUN", NOON, None), (2, "m", "DOWN", NOON + timedelta(hours=1), NOON + timedelta(hours=2)),
         (3, "m", "IDLE", NOON + timedelta(hours=5), None)],
        "id int, machine_id string, state string, start_time timestamp, end_time timestamp",
    )
    got = {r.id: r.end_time for r in facts.state_intervals(states).collect()}
    assert got == {1: NOON + timedelta(hours=1), 2: NOON + timedelta(hours=2), 3: None}


def test_t15_one_bad_member_keeps_the_others(frame):
    schema = "deviceId string, source string, equipmentType string, building string, ts_utc bigint, value map<string,string>, metadata map<string,string>"
    events = frame(
        [
            ("d", "bms", "AHU", "b", 1000, {"Supply_Temp": "bad", "Return_Temp": "21.5"}, {"deviceId": "d"}),
            (None, "bms", "AHU", "b", 1000, {"x": "1"}, {}),
            ("e", "bms", "AHU", "b", None, {"x": "1"}, {}),
            ("f", "bms", "AHU", "b", 5, {"x": "1"}, {"deviceId": "f"}),
            ("g", "bms", "AHU", "b", 5, {"x": "NaN", "y": "-Infinity", "z": "2"}, {"deviceId": "g"}),
            ("h", "bms", "AHU", "b", 5, {"x": "1"}, {"source": "bms"}),
            ("i", "bms", "AHU", "b", 2_600_000_000_000, {"x": "1"}, {"deviceId": "i"}),
        ],
        schema,
    )
    parsed = landing.from_text_members(events)
    latest = F.lit("2030-01-01").cast("timestamp")
    assert table(landing.quarantined(parsed, latest), "reason") == [
        ("bad value: Supply_Temp",), ("bad value: x,y",), ("missing deviceId",), ("missing metadata deviceId",),
        ("missing ts_utc",), ("time in the future",)
    ]
    landed = {r.device_id: r.value for r in landing.land(landing.accepted(parsed, latest)).collect()}
    assert landed == {"d": {"Return_Temp": 21.5}, "f": {"x": 1.0}, "g": {"z": 2.0}}


def test_t15_text_that_is_no_number_becomes_null(raw):
    stg = staging.telemetry(raw(raw_row("a", "AHU", {"Supply_Temp": 1.0})).withColumn(
        "value", F.create_map(F.lit("Supply_Temp"), F.lit("bad"), F.lit("Return_Temp"), F.lit("3.25"))
    ))
    got = stg.first()
    assert got.ahu_supply_temp is None and got.ahu_return_temp == Decimal("3.25")


def test_t16_supply_temp_feeds_two_columns(raw):
    got = staging.telemetry(raw(raw_row("a", "Air Coolers", {"Supply_Temp": 1.5}))).first()
    assert got.ahu_supply_temp == got.cooler_supply_temp == Decimal("1.5")


def test_t17_building_codes(raw):
    stg = staging.telemetry(
        raw(*[raw_row("a", "AHU", {}, building=f"Building-{b}") for b in ("Alpha", "Beta", "Gamma", "Delta", "Delta")])
    )
    assert table(dims.location(stg), "building_code", "building_order", "campus") == [
        ("BA", 1, "Facility"), ("BB", 2, "Facility"), ("BG", 3, "Facility"), ("De", 9, "Facility")
    ]


def test_t18_replays_are_removed(raw):
    copies = [raw_row("a", "AHU", {"x": 1.0}, msg="7") for _ in range(5)] + [raw_row("a", "AHU", {"x": 1.0}, msg="8")]
    assert landing.dedupe(raw(*copies)).count() == 2
    later = raw_row("a", "AHU", {"x": 2.0}, NOON + timedelta(minutes=1), msg="7")
    unnamed = [raw_row("a", "AHU", {"x": 9.0}, msg=None) for _ in range(2)]
    got = landing.dedupe(raw(later, *copies, *unnamed))
    assert table(got, F.col("metadata")["msgId"], "value") == [
        (None, {"x": 9.0}), (None, {"x": 9.0}), ("7", {"x": 1.0}), ("8", {"x": 1.0})
    ]


def test_t18_only_copies_are_sorted(spark, frame):
    # Rows that could not be broadcast: the full rows are looked up in a table of the repeated ids, not sorted by id.
    stored = frame([(str(i % 90), i, f"d{i % 7}") for i in range(100)] + [(None, 1, "d")], "msg_id string, time int, device_id string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = landing.dedupe(stored, F.col("msg_id"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
        assert table(got) == sorted([(None, 1, "d")] + [(str(i), i, f"d{i % 7}") for i in range(90)], key=lambda t: tuple((v is not None, str(v)) for v in t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_content_id_is_stable(frame):
    schema = "deviceId string, source string, equipmentType string, building string, ts_utc bigint, value map<string,double>, metadata map<string,string>"
    events = frame(
        [("d", "bms", "AHU", "b", 1, {"a": 1.0, "b": 2.0}, {"k": "v"}), ("d", "bms", "AHU", "b", 1, {"b": 2.0, "a": 1.0}, {"k": "v"}),
         ("d", "bms", "AHU", "b", 1, {"a": 1.0}, {"msgId": "own"})],
        schema,
    )
    ids = [r.metadata["msgId"] for r in landing.content_id(events).collect()]
    assert ids[0] == ids[1] and len(ids[0]) == 64 and ids[2] == "own"


def test_json_forms(spark):
    df = spark.range(1).select(
        maps.values_json(F.create_map(F.lit("a"), F.lit(1.5))).alias("v"),
        maps.values_json(F.lit(None).cast("map<string,double>")).alias("none"),
        maps.dimensions_json(F.lit("b"), F.lit("t"), F.lit("d")).alias("d"),
        maps.metadata_json(F.create_map(F.lit("a"), F.lit("x"))).alias("m"),
    )
    got = df.first()
    assert json.loads(got.v) == {"a": 1.5} and got.none == "{}"
    assert json.loads(got.d) == {"building": "b", "equipmentType": "t", "name": "d"} and json.loads(got.m) == {"a": "x"}


def test_named_sql_functions(spark):
    from millwatt.functions import sql

    sql.register(spark)
    sql.register(spark)
    got = spark.sql(
        "SELECT map_to_json(map('a', 1.5D)) v, map_to_json(NULL) n, meta_to_json(map('k', 'x')) m, build_dims('b', 't', 'd') d"
    ).first()
    assert json.loads(got.v) == {"a": 1.5} and got.n == "{}" and json.loads(got.m) == {"k": "x"}
    assert json.loads(got.d) == {"building": "b", "equipmentType": "t", "name": "d"}


def test_topics(frame):
    pairs = [("bms", kind, topic) for kind, topic in C.BMS_TOPICS.items()]
    pairs += [("ems", kind, topic) for kind, topic in C.EMS_TOPICS.items()]
    pairs += [("bms", "CNC", "bms.unknown"), ("ems", "AHU", "ems.unknown"), ("ems", None, "ems.unknown")]
    got = frame(pairs, "s string, t string, want string").select(labels.topic(F.col("s"), F.col("t")), "want")
    assert all(a == b for a, b in got.collect())


def test_flags_and_tags(frame):
    df = frame([("1", " NULL "), ("TRUE", " a "), ("t", ""), ("0", "NULL"), (None, None)], "flag string, tag string")
    got = df.select(labels.is_true(F.col("flag")), labels.tag(F.col("tag"))).collect()
    assert [tuple(r) for r in got] == [(True, None), (True, "a"), (True, None), (False, None), (False, None)]


def test_rounding_and_ratios(spark):
    got = spark.sql("select 1.005D a, 2D b, 0D z").select(
        half_up(F.col("a"), 2), ratio(F.col("a"), F.col("z")), ratio(F.col("b"), F.lit(4))
    ).first()
    assert tuple(got) == (Decimal("1.01"), None, 0.5)


def words(value: float) -> list[int]:
    return list(struct.unpack(">HH", struct.pack(">f", value)))


def test_registers_decode_like_ieee(frame):
    values = [0.0, -0.0, 1.0, -1.5, 6.8, 1e-42, 3.4e38, -7.25e-10, 123456.789]
    rows = [(i, words(v) + words(-v) + [1]) for i, v in enumerate(values)]
    df = frame(rows, "i int, r array<int>").select("i", registers.decode_block(F.col("r")).alias("d"))
    for r in df.collect():
        exact = struct.unpack(">f", struct.pack(">f", values[r.i]))[0]
        assert r.d == [exact, -exact]
    special = frame([(0, [0x7F80, 0]), (1, [0xFF80, 0]), (2, [0x7FC0, 1]), (3, [])], "i int, r array<int>")
    got = {r.i: r.d for r in special.select("i", registers.decode_block(F.col("r")).alias("d")).collect()}
    assert got[0] == [float("inf")] and got[1] == [float("-inf")] and got[2][0] != got[2][0] and got[3] == []


def test_registers_encode_like_ieee(frame):
    rng = random.Random(3)
    values = [0.0, -0.0, 1.0, -1.0, 2.0, 0.1, 3.4e38, -1.17549435e-38, 1e-42, 1.4e-45, float("inf"), float("-inf"), 16777217.0]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-40, 38) for _ in range(300)]
    values += [2.0**e for e in range(-149, 128)] + [float(struct.unpack(">f", struct.pack(">f", 2.0**e * (2 - 2**-23)))[0]) for e in range(-126, 128)]
    df = frame(list(enumerate(values)), "i int, v double").select("i", registers.encode_block(F.array("v")).alias("w"))
    for r in df.collect():
        assert r.w == words(values[r.i]), values[r.i]
    block = frame([([1.5, -2.25],), ([],), (None,)], "v array<double>").select(registers.encode_block(F.col("v")).alias("b"))
    assert [r.b for r in block.collect()] == [words(1.5) + words(-2.25), [], None]


def test_register_keys_stop_at_a_short_block(frame):
    df = frame([(words(1.0), ["a", "b"])], "r array<int>, k array<string>")
    assert df.select(registers.decode_metrics(F.col("r"), F.col("k"))).first()[0] == {"a": 1.0}


def test_integration_starts_at_zero(frame):
    rows = [("d", NOON, "1", 10.0), ("d", NOON + timedelta(minutes=30), "2", 20.0), ("d", NOON + timedelta(hours=1), "3", None),
            ("d", NOON + timedelta(hours=2), "4", 1.0)]
    for max_rows in (1, 100):
        df = signals.integrate_energy(frame(rows, "device_id string, time timestamp, msg_id string, total_power double"), max_rows=max_rows)
        assert [r.total_kwh for r in df.orderBy("time").collect()] == [0, 10, 10, 11]


def test_spikes_need_history_and_spread(frame):
    flat = [("flat", NOON + timedelta(minutes=i), str(i), 5.0) for i in range(12)] + [("flat", NOON + timedelta(minutes=99), "x", 500.0)]
    wavy = [("wavy", NOON + timedelta(minutes=i), str(i), 5.0 + i % 2) for i in range(12)] + [("wavy", NOON + timedelta(minutes=99), "x", 50.0)]
    df = frame(flat + wavy, "device_id string, time timestamp, msg_id string, total_power double")
    got = signals.spikes(df, order=("time", "msg_id"), block_rows=10).collect()
    assert [(r.device_id, r.msg_id) for r in got] == [("wavy", "x")]
    assert got[0].baseline == 5.5 and got[0].z_score == pytest.approx(89.0)


def test_spikes_on_large_readings_with_little_spread(frame):
    rows = [("d", NOON + timedelta(minutes=i), str(i), 1_000_000 + 0.001 * (-1) ** i) for i in range(12)]
    rows += [("d", NOON + timedelta(minutes=99), "x", 1_000_000.05)]
    got = signals.spikes(frame(rows, "device_id string, time timestamp, msg_id string, total_power double"), block_rows=10).collect()
    assert [r.msg_id for r in got] == ["x"] and got[0].z_score == pytest.approx(50, rel=1e-3)


def test_late_rows(frame):
    rows = [(1, NOON), (2, NOON + timedelta(seconds=40)), (3, NOON + timedelta(seconds=10)), (4, NOON + timedelta(seconds=9)),
            (5, NOON + timedelta(seconds=100))]
    df = frame(rows, "arrival bigint, time timestamp")
    for size in (1, 2, 1000):
        assert table(signals.late_rows(df, "arrival", max_rows=size), "arrival") == [(4,)]


def test_stuck_values(frame):
    values = [1, 1, 1, 2, 2, 1, 1, 1, 1, None, None, None]
    rows = [("d", NOON + timedelta(minutes=i), i, v) for i, v in enumerate(values)]
    df = frame(rows, "device_id string, time timestamp, n int, v int")
    for max_rows in (2, 100):
        got = signals.stuck_values(df, ["device_id"], "v", ["time", "n"], max_rows=max_rows)
        assert table(got, "stuck_at", "rows") == [(1, 3), (1, 4)]


def test_state_steps(frame):
    rows = [(i, "m", s, NOON + timedelta(hours=i)) for i, s in enumerate(["IDLE", "RUN", "DOWN", "RUN"])]
    got = signals.state_steps(frame(rows, "id int, machine_id string, state string, start_time timestamp"))
    assert [r.allowed for r in got.orderBy("id").collect()] == [True, True, True, False]


def test_calibration_widens_flat_ranges(raw):
    got = registry.calibrate(
        raw(raw_row("a", "AHU", {"x": -10.0, "y": 1.0}), raw_row("a", "AHU", {"x": -10.0, "y": 3.0}))
    )
    assert {r.metric: (r.lo, r.hi, r.nominal) for r in got.collect()} == {"x": (-11.0, -9.0, -10.0), "y": (1.0, 3.0, 2.0)}


def test_fleet_ids(frame):
    got = registry.expand_fleet(frame([("Building-Beta", "HEATING", 2), ("Building-Delta", "CNC", 0)], "building string, machine_type string, machines int"))
    assert table(got, "machine_id", "rated_power_kw", "topic") == [
        ("BB-HEAT-01", 220.0, "ems.machine.heating"), ("BB-HEAT-02", 220.0, "ems.machine.heating")
    ]


def test_setpoints_and_low_delta(spark, raw):
    key = "Chilled_Water_{}_Temp"
    rows = raw(
        raw_row("a", "Chillers", {key.format("Supply"): 8.0, key.format("Return"): 11.0}),
        raw_row("b", "Chillers", {key.format("Supply"): 6.0, key.format("Return"): 13.0}),
    )
    got = signals.setpoint_deviation(rows, signals.profile_metrics(spark))
    assert {(r.device_id, r.metric): r.mean_deviation for r in got.collect()}[("a", key.format("Return"))] == -3.0
    assert table(signals.low_delta(staging.chiller(staging.telemetry(rows))), "device_name", "nominal_delta") == [("a", 7.0)]


def test_panels_take_the_last_day(raw):
    rows = raw(
        raw_row("a", "AHU", {"Supply_Temp": 10.0}, NOON - timedelta(hours=25), msg="1"),
        raw_row("a", "AHU", {"Supply_Temp": 12.0}, NOON, msg="2"),
        raw_row("b", "AHU", {"Supply_Temp": 15.0}, NOON + timedelta(seconds=59), msg="3"),
        raw_row("b", "AHU", {"Return_Temp": 15.0}, NOON + timedelta(seconds=5), msg="4"),
    )
    got = panels.supply_temp(staging.telemetry(rows)).collect()
    assert [(r.bucket, r.avg_supply_temp) for r in got] == [(NOON, 13.5)]
    fixed = panels.supply_temp(staging.telemetry(rows), as_of=F.lit(NOON - timedelta(hours=1)).cast("timestamp"), hours=24)
    assert fixed.count() == 2


def test_rollups_agree(frame):
    rows = [("d", NOON + timedelta(seconds=20 * i), Decimal(i), Decimal(1)) for i in range(400)]
    energy = frame(rows, "device_id string, time timestamp, total_power decimal(28,12), delta_kwh_reset_safe decimal(28,12)")
    hours = rollups.by_hour(rollups.by_minute(energy)).orderBy("bucket").collect()
    assert [r.readings for r in hours] == [180, 180, 40] and sum(r.kwh for r in hours) == 400
    assert hours[0].power_avg == 89.5 and (hours[1].power_min, hours[1].power_max) == (180, 359)


def test_fan_out_does_not_multiply_energy(frame):
    shifts = frame([(1, "A", 0, 24, "x")], "shift_id int, shift_code string, start_hour int, end_hour int, crew string")
    energy = frame([("m", NOON + timedelta(minutes=i), Decimal(2)) for i in range(10)], "machine_id string, time timestamp, delta_kwh_reset_safe decimal(28,12)")
    runs = frame([("m", NOON, 4) for _ in range(3)] + [("other", NOON, 8)], "machine_id string, start_time timestamp, good_qty int")
    got = analytics.kwh_per_unit(energy, runs, shifts).collect()
    assert [(r.shift_code, r.total_kwh, r.total_units, r.kwh_per_unit) for r in got] == [("A", 20, 20, 1.0)]


def test_checks_count_like_declared(frame):
    parents = frame([(1,), (2,)], "id int")
    child = frame([(1, "x"), (1, "x"), (3, "y"), (3, None), (None, "z")], "id int, kind string")
    checks = [
        quality.Check("child", "id", "not_null"),
        quality.Check("child", "kind", "not_null"),
        quality.Check("child", "id", "unique"),
        quality.Check("child", "kind", "unique"),
        quality.Check("child", "id", "relationships", to_model="parents", to_column="id"),
        quality.Check("child", "kind", "accepted_values", ("x", "q")),
        quality.Check("parents", "id", "unique"),
    ]
    got = {(r["model"], r["column"], r["test"]): r.failures for r in quality.run({"child": child, "parents": parents}, checks).collect()}
    assert got == {
        ("child", "id", "not_null"): 1, ("child", "kind", "not_null"): 1, ("child", "id", "unique"): 2,
        ("child", "kind", "unique"): 1, ("child", "id", "relationships"): 2, ("child", "kind", "accepted_values"): 2,
        ("parents", "id", "unique"): 0,
    }
    with pytest.raises(ValueError):
        quality.run({"child": child}, [quality.Check("child", "id", "strange")])


def test_declared_checks_are_complete():
    counts = {}
    for check in quality.ALL_CHECKS:
        counts[check.test] = counts.get(check.test, 0) + 1
    assert counts == {"not_null": 20, "unique": 11, "relationships": 9, "accepted_values": 4}


def test_shift_date_of_plain_shift(spark):
    got = spark.sql("select timestamp'2024-01-06 03:00:00' t").select(
        clock.shift_date(F.col("t"), F.lit(0), F.lit(6))
    ).first()[0]
    assert got == date(2024, 1, 6)


def test_captured_runs_and_states_are_the_latest_and_live(frame):
    run = "run_id int, work_order_id int, machine_id string, good_qty int, scrap_qty int, started_at timestamp, ended_at timestamp"
    change = ", __op string, __source_ts_ms bigint, __lsn bigint, __deleted string"
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    runs = [
        (1, 1, "m", 0, None, t0, None, "c", 1, 1, "false"), (1, 1, "m", 5, 1, t0, t1, "u", 2, 2, "false"),
        (2, 1, "m", 3, 0, t0, None, "c", 1, 3, "false"), (2, 1, "m", 3, 0, t0, None, "d", 2, 4, "true"),
    ]
    got = staging.production_runs(frame(runs, run + change))
    assert table(got, "id", "total_qty", "end_time") == [(1, 6, t1)]
    states = [(1, "m", "RUN", t0, None, "c", 1, 1, "false"), (1, "m", "RUN", t0, t1, "u", 1, 2, "false"), (2, "m", "DOWN", t1, None, "d", 1, 3, "true")]
    got = staging.machine_states(frame(states, "state_id int, machine_id string, state string, started_at timestamp, ended_at timestamp" + change))
    assert table(got, "id", "end_time") == [(1, t1)]


def test_variant_members_of_any_depth_and_type(frame):
    from millwatt.functions import variants

    texts = ['{"v": {"p": 1.5, "a": [{"x": 7}]}, "n": "2.25"}', '{"v": {"p": "off"}, "n": 3}', "no json", None, "[1]", '{"v": 5}']
    df = frame(list(enumerate(texts)), "i int, body string").withColumn("body", variants.parse(F.col("body")))
    got = variants.members(
        df.withColumn("n", variants.number(F.col("body"), "$.n")), "body",
        {"p": ("$.v.p", "double"), "x": ("$.v.a[0].x", "int"), "v": ("$.v", "int")},
    )
    none = (None,) * 4
    assert table(got, "i", "n", "p", "x", "v") == [
        (0, Decimal("2.25"), 1.5, 7, None), (1, Decimal(3), None, None, None), (2, *none), (3, *none), (4, *none), (5, None, None, None, 5),
    ]
    shapes = variants.shapes(df.where("i in (0, 1)"), "body", "i")
    assert table(shapes)[1] == (1, "OBJECT<n: BIGINT, v: OBJECT<p: STRING>>")
