"""SQL of the plant views, written separately from the Spark code; each entry is one CTE."""

from __future__ import annotations

import re

NUM = "DECIMAL(28,12)"


def _types(number: str, names: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE ({number}) % {len(names)} {cases} END"


def _tag(number: str) -> str:
    return f"'D-' || lpad(CAST({number} AS VARCHAR), 6, '0')"


BUILDINGS = ("Building-Alpha", "Building-Beta", "Building-Gamma", "Building-Delta")
CODE = """CASE building WHEN 'Building-Alpha' THEN 'BA' WHEN 'Building-Beta' THEN 'BB'
  WHEN 'Building-Gamma' THEN 'BG' ELSE substr(building, 10, 2) END"""
TOPIC = """CASE equipment_type WHEN 'AHU' THEN 'bms.hvac.ahu' WHEN 'Chillers' THEN 'bms.hvac.chiller'
  WHEN 'INJECTION_MOULDING' THEN 'ems.machine.injection_moulding' WHEN 'CNC' THEN 'ems.machine.cnc'
  WHEN 'HEATING' THEN 'ems.machine.heating' END"""


def _key(*parts: str) -> str:
    joined = " || '|' || ".join(f"CAST({part} AS VARCHAR)" for part in parts)
    return f"CAST(('0x' || substr(md5({joined}), 1, 15)) AS BIGINT)"


VIEWS: dict[str, str] = {}

VIEWS["ev"] = f"""
SELECT event_id, CAST(event_id AS VARCHAR) AS msg_id, user_id, event_type, value,
  CAST(props->>'$.k' AS INTEGER) AS k, date_trunc('milliseconds', ts) AS time, ts,
  {_tag('user_id')} AS device_id, user_id % 5 AS kind,
  {_types('user_id', ('AHU', 'Chillers', 'INJECTION_MOULDING', 'CNC', 'HEATING'))} AS equipment_type,
  {_types('user_id', BUILDINGS)} AS building,
  CASE WHEN user_id % 5 < 2 THEN 'bms' ELSE 'ems' END AS source
FROM events"""

VIEWS["reading"] = f"""
SELECT *,
  CASE WHEN kind = 0 AND k % 17 <> 0 THEN value / 10 END AS r_supply,
  CASE WHEN kind = 0 AND k % 19 <> 0 THEN k / 3.0::DOUBLE END AS r_return,
  CASE WHEN kind = 0 THEN k::DOUBLE END AS r_supply_rh,
  CASE WHEN kind = 0 THEN k / 2.0::DOUBLE END AS r_return_rh,
  CASE WHEN kind = 0 AND event_type = 'view' THEN value END AS r_flow,
  CASE WHEN kind = 1 AND k % 17 <> 0 THEN value / 10 - 1.0 END AS r_cws,
  CASE WHEN kind = 1 AND k % 19 <> 0 THEN k / 3.0::DOUBLE END AS r_cwr,
  CASE WHEN kind = 1 THEN k / 10.0::DOUBLE + 27 END AS r_cds,
  CASE WHEN kind = 1 THEN k / 10.0::DOUBLE + 30 END AS r_cdr,
  CASE WHEN kind >= 2 AND k % 23 <> 0 THEN value END AS r_power,
  CASE WHEN kind >= 2 THEN event_id / 4.0::DOUBLE + value / 100 END AS r_energy
FROM ev"""

VIEWS["stg"] = f"""
SELECT *, {TOPIC} AS topic,
  CAST(r_supply AS {NUM}) AS ahu_supply_temp, CAST(r_return AS {NUM}) AS ahu_return_temp,
  CAST(r_supply_rh AS {NUM}) AS ahu_supply_rh, CAST(r_return_rh AS {NUM}) AS ahu_return_rh,
  CAST(r_flow AS {NUM}) AS ahu_supply_flow,
  CAST(r_cws AS {NUM}) AS chiller_cws_temp, CAST(r_cwr AS {NUM}) AS chiller_cwr_temp,
  CAST(r_cds AS {NUM}) AS chiller_cds_temp, CAST(r_cdr AS {NUM}) AS chiller_cdr_temp,
  CAST(r_power AS {NUM}) AS total_power, CAST(r_energy AS {NUM}) AS total_energy
FROM reading"""

VIEWS["longm"] = """
SELECT event_id, msg_id, time, device_id, equipment_type, metric, reading FROM (
  SELECT *, 'Supply_Temp' AS metric, r_supply AS reading FROM reading
  UNION ALL SELECT *, 'Return_Temp', r_return FROM reading
  UNION ALL SELECT *, 'Supply_RH', r_supply_rh FROM reading
  UNION ALL SELECT *, 'Return_RH', r_return_rh FROM reading
  UNION ALL SELECT *, 'Supply_Flow', r_flow FROM reading
  UNION ALL SELECT *, 'Chilled_Water_Supply_Temp', r_cws FROM reading
  UNION ALL SELECT *, 'Chilled_Water_Return_Temp', r_cwr FROM reading
  UNION ALL SELECT *, 'Condensor_Supply_Temp', r_cds FROM reading
  UNION ALL SELECT *, 'Condensor_Return_Temp', r_cdr FROM reading
  UNION ALL SELECT *, 'totalPower', r_power FROM reading
  UNION ALL SELECT *, 'totalEnergy', r_energy FROM reading
) WHERE reading IS NOT NULL"""

VIEWS["profile"] = """
SELECT * FROM (VALUES
  ('Chillers', 'Chilled_Water_Supply_Temp', '°C', 7.0), ('Chillers', 'Chilled_Water_Return_Temp', '°C', 14.0),
  ('Chillers', 'Condensor_Supply_Temp', '°C', 29.0), ('Chillers', 'Condensor_Return_Temp', '°C', 32.0),
  ('AHU', 'Supply_Temp', '°C', 14.0), ('AHU', 'Return_Temp', '°C', 25.0), ('AHU', 'Supply_RH', '%', 58.0),
  ('AHU', 'Return_RH', '%', 55.0), ('AHU', 'Supply_Flow', 'L/s', 1000.0)
) AS p(equipment_type, metric, unit, setpoint)"""

VIEWS["ahu"] = """
SELECT *, coalesce(ahu_return_temp - ahu_supply_temp, 0) AS delta_temp,
  ahu_return_temp - ahu_supply_temp AS delta_temp_nullable,
  CASE WHEN ahu_supply_temp IS NULL THEN 'MISSING' WHEN ahu_supply_temp BETWEEN 10 AND 20 THEN 'OK'
    ELSE 'WARN' END AS supply_temp_status
FROM stg WHERE equipment_type = 'AHU'"""

VIEWS["chiller"] = """
SELECT *, coalesce(chiller_cwr_temp - chiller_cws_temp, 0) AS delta_temp,
  chiller_cwr_temp - chiller_cws_temp AS delta_temp_nullable,
  CASE WHEN chiller_cws_temp > 0 THEN round(CAST(
    CAST(chiller_cwr_temp - chiller_cws_temp AS DOUBLE) / CAST(chiller_cws_temp AS DOUBLE) * 100
    AS DECIMAL(28,10)), 2) END AS delta_pct,
  CASE WHEN chiller_cws_temp IS NULL THEN 'MISSING' WHEN chiller_cws_temp BETWEEN 4 AND 12 THEN 'OK'
    ELSE 'WARN' END AS supply_temp_status
FROM stg WHERE equipment_type = 'Chillers'"""

VIEWS["master"] = f"""
SELECT s_suppkey AS id, s_name AS name,
  {_types('s_suppkey', ('AHU', 'Chiller', 'Cooling Tower', 'Pumps', 'Air Compressor'))} AS type,
  {_types('s_suppkey', BUILDINGS)} AS building,
  {_tag('s_suppkey + 2')} AS energytag,
  CASE WHEN s_suppkey % 5 < 2 THEN {_tag('s_suppkey')} END AS bmstag,
  s_nationkey % 3 < 2 AS is_active
FROM supplier"""

VIEWS["machines"] = f"""
SELECT * FROM (
  SELECT {_tag('s_suppkey')} AS machine_id,
    {_types('s_suppkey', ('HVAC', 'HVAC', 'INJECTION_MOULDING', 'CNC', 'HEATING'))} AS machine_type,
    {_types('s_suppkey', BUILDINGS)} AS building,
    {_tag('s_suppkey')} AS energy_tag,
    CAST(floor(s_acctbal / 100) + 1 AS DECIMAL(8,2)) AS rated_power_kw, s_acctbal > 0 AS is_active
  FROM supplier) WHERE machine_type IN ('INJECTION_MOULDING', 'CNC', 'HEATING')"""

VIEWS["shift"] = """
SELECT r_regionkey AS shift_id, chr(65 + r_regionkey) AS shift_code,
  (r_regionkey * 5 + 22) % 24 AS start_hour,
  CASE r_regionkey WHEN 4 THEN 22 ELSE (r_regionkey * 5 + 27) % 24 END AS end_hour, r_name AS crew
FROM region"""

VIEWS["wolog"] = f"""
SELECT o_orderkey AS work_order_id, 'WO-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_no,
  o_custkey AS product_id, {_tag('o_custkey // 10')} AS machine_id,
  CAST(floor(o_totalprice / 1000) AS INTEGER)
    + CASE WHEN version = 2 AND o_custkey % 2 = 0 THEN 10 ELSE 0 END AS planned_qty,
  CAST(o_orderdate AS DATE) AS due_date,
  CASE WHEN version = 0 THEN 'PLANNED' WHEN o_orderstatus = 'P' THEN 'RELEASED'
    WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'DONE' END AS status,
  CASE version WHEN 0 THEN o_orderdate - INTERVAL 3 DAY WHEN 1 THEN o_orderdate
    ELSE o_orderdate + INTERVAL 1 DAY END AS updated_at, version
FROM orders, (VALUES (0), (1), (2)) AS n(version)"""

VIEWS["wo"] = "SELECT * EXCLUDE (updated_at, version) FROM wolog WHERE version = 2"

VIEWS["runs"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS work_order_id, {_tag('l_suppkey')} AS machine_id,
  CAST(l_quantity AS INTEGER) AS good_qty, CAST(round(l_discount * 100) AS INTEGER) AS scrap_qty,
  CAST(l_quantity AS INTEGER) + CAST(round(l_discount * 100) AS INTEGER) AS total_qty,
  TIMESTAMP '2024-01-01' + to_days(CAST(l_orderkey % 30 AS INTEGER)) + to_hours(l_partkey % 24)
    + to_minutes(l_linenumber * 7) AS start_time,
  CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O') THEN
    TIMESTAMP '2024-01-01' + to_days(CAST(l_orderkey % 30 AS INTEGER)) + to_hours(l_partkey % 24)
    + to_minutes(l_linenumber * 7) + to_minutes(CAST(l_quantity AS INTEGER)) END AS end_time
FROM lineitem"""

VIEWS["states"] = """
SELECT event_id AS id, device_id AS machine_id,
  CASE WHEN event_type IN ('purchase', 'view') THEN 'RUN' WHEN event_type IN ('click', 'signup') THEN 'IDLE'
    ELSE 'DOWN' END AS state,
  time AS start_time, CASE WHEN event_type = 'error' THEN time + INTERVAL 30 MINUTE END AS recorded_end
FROM ev"""

VIEWS["intervals"] = """
SELECT id, machine_id, state, start_time,
  coalesce(recorded_end, lead(start_time) OVER (PARTITION BY machine_id ORDER BY start_time, id)) AS end_time
FROM states"""

VIEWS["changes"] = """
SELECT user_id AS device_no, event_type AS status, value AS amount,
  CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
  epoch_ms(ts) // 60000 * 60000 AS ts_ms, event_id AS lsn,
  CASE event_type WHEN 'error' THEN 'true' ELSE 'false' END AS deleted
FROM events"""

VIEWS["lastchange"] = """
SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY device_no ORDER BY ts_ms DESC, lsn DESC) = 1"""

VIEWS["dim_equipment"] = f"""
SELECT {_key('id', 'name')} AS equipment_key, id, name, type AS equipment_type, building, {CODE} AS building_code,
  energytag, bmstag, is_active
FROM master WHERE type IN ('Chiller', 'AHU', 'Cooling Tower', 'Air Compressor', 'Air Coolers')"""

VIEWS["dim_machine"] = f"""
SELECT {_key('machine_id')} AS machine_key, machine_id, machine_type, building, {CODE} AS building_code, energy_tag,
  rated_power_kw,
  CASE machine_type WHEN 'INJECTION_MOULDING' THEN 1 WHEN 'CNC' THEN 2 WHEN 'HEATING' THEN 3 END AS machine_type_order
FROM machines"""

VIEWS["dim_work_order"] = """
SELECT row_number() OVER (ORDER BY work_order_id) AS work_order_key, * FROM wo"""

VIEWS["hvac"] = f"""
SELECT equipment_key, CAST(time AS DATE) AS date_id, CAST(hour(time) * 60 + minute(time) AS INTEGER) AS time_key,
  time, msg_id, r.device_id AS device_name, r.building, r.equipment_type, supply_temp, return_temp, supply_rh,
  return_rh, supply_flow, delta_temp, delta_temp_nullable, supply_temp_status, cws_temp, cwr_temp
FROM (
  SELECT time, msg_id, device_id, building, equipment_type, ahu_supply_temp AS supply_temp,
    ahu_return_temp AS return_temp, ahu_supply_rh AS supply_rh, ahu_return_rh AS return_rh,
    ahu_supply_flow AS supply_flow, delta_temp, delta_temp_nullable, supply_temp_status,
    NULL::{NUM} AS cws_temp, NULL::{NUM} AS cwr_temp FROM ahu
  UNION ALL
  SELECT time, msg_id, device_id, building, equipment_type, NULL, NULL, NULL, NULL, NULL, delta_temp,
    delta_temp_nullable, supply_temp_status, chiller_cws_temp, chiller_cwr_temp FROM chiller
) r JOIN dim_equipment e ON r.device_id = e.bmstag
WHERE time >= TIMESTAMP '2024-01-01' AND time < TIMESTAMP '2027-01-01'"""

VIEWS["energy0"] = """
SELECT machine_key, CAST(time AS DATE) AS date_id, CAST(hour(time) * 60 + minute(time) AS INTEGER) AS time_key,
  time, msg_id, s.device_id, m.machine_id, m.machine_type, m.building, m.building_code, m.energy_tag,
  s.total_power, s.total_energy,
  s.total_energy - lag(s.total_energy) OVER (PARTITION BY s.device_id ORDER BY time, msg_id) AS delta_kwh
FROM stg s JOIN dim_machine m ON s.device_id = m.energy_tag
WHERE s.equipment_type IN ('INJECTION_MOULDING', 'CNC', 'HEATING')
  AND time >= TIMESTAMP '2024-01-01' AND time < TIMESTAMP '2027-01-01'"""

VIEWS["energy"] = """
SELECT *, CASE WHEN delta_kwh < 0 THEN total_energy ELSE delta_kwh END AS delta_kwh_reset_safe FROM energy0"""

VIEWS["production"] = """
SELECT work_order_key, machine_key, w.work_order_id, w.product_id, w.machine_id, w.planned_qty, w.status,
  r.good_qty, r.scrap_qty, r.total_qty, r.start_time, r.end_time,
  (epoch_us(r.end_time) - epoch_us(r.start_time)) / 60e6 AS duration_minutes
FROM dim_work_order w LEFT JOIN dim_machine m ON w.machine_id = m.machine_id
LEFT JOIN runs r ON w.work_order_id = r.work_order_id"""

VIEWS["machine_state"] = """
SELECT machine_key, CAST(start_time AS DATE) AS date_id,
  CAST(hour(start_time) * 60 + minute(start_time) AS INTEGER) AS time_key, i.machine_id, state, start_time, end_time,
  (epoch_us(end_time) - epoch_us(start_time)) / 60e6 AS duration_minutes
FROM intervals i JOIN dim_machine m ON i.machine_id = m.machine_id"""

VIEWS["production_captured"] = f"""
SELECT work_order_key, machine_key, w.work_order_id, w.product_id, w.machine_id, w.planned_qty, w.status,
  r.good_qty, r.scrap_qty, r.good_qty + r.scrap_qty AS total_qty, r.start_time, r.start_time + to_minutes(r.minutes) AS end_time,
  CAST(r.minutes AS DOUBLE) AS duration_minutes
FROM dim_work_order w LEFT JOIN dim_machine m ON w.machine_id = m.machine_id
LEFT JOIN (SELECT o_orderkey AS work_order_id, CAST(o_custkey % 90 AS INTEGER) AS good_qty, CAST(o_custkey % 7 AS INTEGER) AS scrap_qty,
    TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) + to_hours(o_custkey % 24) AS start_time,
    CAST(o_orderkey % 50 + 1 AS INTEGER) AS minutes
  FROM orders WHERE o_orderkey % 10 <> 0) r ON w.work_order_id = r.work_order_id"""

VIEWS["machine_state_captured"] = """
SELECT machine_key, CAST(start_time AS DATE) AS date_id,
  CAST(hour(start_time) * 60 + minute(start_time) AS INTEGER) AS time_key, i.machine_id, state, start_time, end_time,
  (epoch_us(end_time) - epoch_us(start_time)) / 60e6 AS duration_minutes
FROM (SELECT machine_id, state, start_time,
    coalesce(recorded_end, lead(start_time) OVER (PARTITION BY machine_id ORDER BY start_time, id)) AS end_time
  FROM states WHERE id % 11 <> 0) i JOIN dim_machine m ON i.machine_id = m.machine_id"""

VIEWS["minute_roll"] = """
SELECT device_id, date_trunc('minute', time) AS bucket, count(total_power) AS readings, sum(total_power) AS power_sum,
  min(total_power) AS power_min, max(total_power) AS power_max, sum(delta_kwh_reset_safe) AS kwh
FROM energy GROUP BY ALL"""

VIEWS["catalog"] = f"""
SELECT DISTINCT s.device_id, s.source, s.equipment_type, s.building, m.energytag AS energy_tag, {TOPIC.replace('equipment_type', 's.equipment_type')} AS topic
FROM stg s LEFT JOIN master m ON s.device_id = m.bmstag"""

VIEWS["calibration"] = """
SELECT device_id, metric,
  CASE WHEN lo = hi THEN lo - abs(lo) * 0.05::DOUBLE - 0.5::DOUBLE ELSE lo END AS lo,
  CASE WHEN lo = hi THEN hi + abs(hi) * 0.05::DOUBLE + 0.5::DOUBLE ELSE hi END AS hi
FROM (SELECT device_id, metric, min(reading) AS lo, max(reading) AS hi FROM longm GROUP BY ALL)"""

VIEWS["worked"] = """
SELECT *, sum(added_work) OVER (PARTITION BY device_id ORDER BY time, msg_id ROWS UNBOUNDED PRECEDING) AS total_work
FROM (SELECT device_id, time, msg_id, total_power, coalesce(CAST(total_power AS DECIMAL(18,6)) * CAST(epoch_us(time)
    - epoch_us(lag(time) OVER (PARTITION BY device_id ORDER BY time, msg_id)) AS DECIMAL(19,0)), 0) AS added_work
  FROM stg WHERE source = 'ems')"""


def _kwh(work: str) -> str:
    """Kilowatt-microseconds as kWh, half up to five places in whole numbers."""
    return f"CAST((CAST({work} * 1000000 AS HUGEINT) * 100000 + 1800000000000000) // 3600000000000000 AS DOUBLE) / 1e5"


VIEWS["integrated"] = f"""
SELECT device_id, time, msg_id, total_power, {_kwh('added_work')} AS added_kwh, {_kwh('total_work')} AS total_kwh
FROM worked"""

VIEWS["hourshift"] = """
SELECT h AS hour_of_day, shift_code, start_hour, end_hour FROM shift, range(0, 24) AS t(h)
WHERE CASE WHEN start_hour <= end_hour THEN h >= start_hour AND h < end_hour ELSE h >= start_hour OR h < end_hour END"""


def shifted(source: str, time: str) -> str:
    """Rows of ``source`` with their shift and the day the shift began."""
    return f"""(SELECT x.*, shift_code, CAST(CASE WHEN start_hour > end_hour AND hour({time}) < end_hour
      THEN CAST({time} AS DATE) - 1 ELSE CAST({time} AS DATE) END AS DATE) AS shift_date
    FROM {source} x JOIN hourshift ON hour({time}) = hour_of_day)"""


def with_views(body: str) -> str:
    """``body`` preceded by the views it names, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", text):
            if name in VIEWS and name not in needed:
                needed.add(name)
                visit(VIEWS[name])
        for name in re.findall(r"\bFROM\s+[a-z_0-9]+ ?[a-z]?, ([a-z_0-9]+)", text):
            if name in VIEWS and name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()
