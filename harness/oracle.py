"""The SQL twin of every query; decimals come out as doubles rounded to six places."""

from __future__ import annotations

from harness.sql_views import CODE, TOPIC, shifted, with_views


def n(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) AS {name}"


def ns(*names: str) -> str:
    return ", ".join(n(name, name) for name in names)


def avg(expression: str, name: str) -> str:
    return n(f"CAST(sum({expression}) AS DOUBLE) / nullif(count({expression}), 0)", name)


SQL: dict[str, str] = {}

SQL["land_telemetry"] = """
SELECT msg_id, time, CAST(time AS DATE) AS date, device_id, source, building, equipment_type, device_id AS name,
  CAST((r_supply IS NOT NULL)::INT + (r_return IS NOT NULL)::INT + (r_supply_rh IS NOT NULL)::INT
  + (r_return_rh IS NOT NULL)::INT + (r_flow IS NOT NULL)::INT + (r_cws IS NOT NULL)::INT + (r_cwr IS NOT NULL)::INT
  + (r_cds IS NOT NULL)::INT + (r_cdr IS NOT NULL)::INT + (r_power IS NOT NULL)::INT
  + (r_energy IS NOT NULL)::INT AS INTEGER) AS metrics
FROM reading"""

SQL["land_json"] = f"""
SELECT msg_id, time,
  '{{"building":"' || building || '","equipmentType":"' || equipment_type || '","name":"' || device_id || '"}}'
    AS dimensions, {n('r_power', 'total_power')}, {n('r_return', 'return_temp')}
FROM reading"""

SQL["topic_routing"] = f"""
SELECT source, equipment_type, {TOPIC} AS topic, count(*) AS records FROM ev GROUP BY ALL"""

_OUTCOME = """CASE WHEN k = 7 OR k = 50 THEN 'missing deviceId' WHEN event_type = 'error' THEN 'bad value: totalPower'
    ELSE 'landed' END"""
_MESSAGE = """CASE WHEN k = 7 THEN 'not json' ELSE '{{"deviceId":' || CASE WHEN k = 50 THEN 'null' ELSE '"' || device_id || '"' END
  || ',"source":"' || source || '","equipmentType":"' || equipment_type || '","building":"' || building
  || '","ts_utc":' || epoch_ms(time) || ',"value":{{"totalPower":' || CASE WHEN event_type = 'error' THEN '"bad"'
  ELSE printf('%.1f', event_id / 2.0) END || ',"level":' || k || '}},"metadata":{{"msgId":"' || event_id
  || '","deviceId":"' || device_id || '"}}}}' END""".replace("{{", "{").replace("}}", "}")

SQL["quarantine_split"] = f"""
SELECT event_id AS "offset", {_OUTCOME} AS outcome,
  CASE WHEN {_OUTCOME} <> 'landed' THEN {_MESSAGE} END AS message,
  CASE WHEN {_OUTCOME} <> 'landed' THEN 'bms.telemetry.test' END AS topic,
  CASE WHEN k <> 7 THEN equipment_type END AS equipment_type,
  CASE WHEN k <> 7 AND event_type <> 'error' THEN round(event_id / 2.0::DOUBLE, 6) END AS total_power,
  CASE WHEN k <> 7 THEN CAST(k AS DOUBLE) END AS level
FROM ev"""

SQL["variant_readings"] = f"""
SELECT event_id AS "offset", CASE WHEN k NOT IN (7, 50) THEN device_id END AS device_id,
  CASE WHEN k <> 7 AND event_type <> 'error' THEN round(event_id / 2.0::DOUBLE, 6) END AS total_power,
  CASE WHEN k <> 7 THEN CAST(k AS INTEGER) END AS level, NULL::DOUBLE AS device_number, NULL::INTEGER AS value_number,
  CASE WHEN k <> 7 AND event_type <> 'error' THEN round(event_id / 2.0::DOUBLE, 6) END AS power,
  CASE WHEN k <> 7 THEN CAST(event_id AS VARCHAR) END AS msg_id, NULL::DOUBLE AS missing
FROM ev"""

SQL["ingest_quarantine"] = f"""
SELECT event_id AS "offset", {_OUTCOME} AS reason, {_MESSAGE} AS message, 'bms.telemetry.test' AS topic
FROM ev WHERE {_OUTCOME} <> 'landed'
UNION ALL SELECT event_id, 'landed', NULL, NULL FROM ev WHERE k NOT IN (7, 50)"""

SQL["compaction_candidates"] = """
SELECT CAST(time AS DATE) AS date, count(*) AS rows, count(DISTINCT device_id) AS devices FROM ev
GROUP BY 1 HAVING CAST(time AS DATE) < (SELECT CAST(max(time) AS DATE) - 7 FROM ev)"""

SQL["retention_filter"] = """
SELECT CAST(time AS DATE) AS date, source, count(*) AS records, min(time) AS oldest FROM ev
WHERE time >= (SELECT max(time) - INTERVAL 14 DAY FROM ev) GROUP BY 1, 2"""

SQL["retention_expired"] = """
SELECT DISTINCT CAST(time AS DATE) AS date FROM ev
WHERE CAST(time AS DATE) < (SELECT CAST(max(time) AS DATE) - 14 FROM ev)"""

_PER_DAY = """
SELECT CAST(time AS DATE) AS date, count(*) AS rows, count(DISTINCT device_id) AS devices, max(time) AS newest FROM"""
SQL["raw_by_day"] = f"{_PER_DAY} ev GROUP BY 1"
SQL["raw_compacted"] = SQL["raw_by_day"]
SQL["raw_retained"] = f"""{_PER_DAY} (SELECT time, device_id FROM ev
  WHERE CAST(time AS DATE) >= (SELECT CAST(max(time) AS DATE) - 14 FROM ev)
  UNION ALL SELECT TIMESTAMP '2950-01-01', device_id FROM ev WHERE event_id = 0) GROUP BY 1"""

SQL["csv_master"] = f"""
SELECT m.id, m.name, type, building, {CODE} AS "buildingCode", energytag AS "energyTag", bmstag AS "bmsTag",
  CASE s_nationkey % 3 WHEN 0 THEN '1' WHEN 1 THEN 'true' ELSE 'f' END AS isactive
FROM master m JOIN supplier ON s_suppkey = m.id"""

SQL["message_dedupe"] = "SELECT msg_id, time, device_id, source FROM ev"

SQL["cdc_events"] = """
SELECT coalesce(b.work_order_id, a.work_order_id) AS work_order_id,
  CASE WHEN b.work_order_id IS NULL THEN 'c' WHEN a.work_order_id IS NULL THEN 'd' ELSE 'u' END AS op,
  b.status AS before_status, b.planned_qty AS before_qty, a.status AS after_status, a.planned_qty AS after_qty
FROM (SELECT * REPLACE (CASE WHEN work_order_id % 10 = 0 THEN -work_order_id * 2 ELSE work_order_id END AS work_order_id)
  FROM wolog WHERE version = 1) b
FULL JOIN (SELECT * REPLACE (CASE WHEN work_order_id % 10 = 0 THEN -work_order_id * 2 - 1 ELSE work_order_id END AS work_order_id)
  FROM wolog WHERE version = 2) a
  ON a.work_order_id = b.work_order_id
WHERE a.work_order_id IS NULL OR b.work_order_id IS NULL OR a.planned_qty <> b.planned_qty
  OR a.status <> b.status OR a.machine_id <> b.machine_id"""

SQL["cdc_unwrap"] = f"SELECT device_no, status, {ns('amount')}, op, ts_ms, lsn, deleted FROM changes"

SQL["cdc_apply_latest"] = f"SELECT device_no, status, {ns('amount')} FROM lastchange WHERE op <> 'd'"

SQL["stream_cdc"] = SQL["cdc_apply_latest"]

SQL["cdc_keep_deleted"] = f"SELECT device_no, status, {ns('amount')}, deleted FROM lastchange"

SQL["cdc_route_counts"] = """
SELECT CASE event_type WHEN 'purchase' THEN 'production_runs' WHEN 'view' THEN 'machine_states'
  WHEN 'click' THEN 'work_orders' WHEN 'signup' THEN 'products' WHEN 'error' THEN 'machines' END AS table_name,
  count(*) AS events FROM events GROUP BY 1"""

SQL["schema_evolution_union"] = """
SELECT work_order_id, CASE WHEN version < 2 THEN machine_id END AS machine_id, CASE WHEN version < 2 THEN due_date END AS due_date,
  CASE WHEN version > 0 THEN status END AS status, CASE WHEN version = 2 THEN planned_qty END AS planned_qty
FROM wolog"""

SQL["stg_work_orders_latest"] = "SELECT * FROM wo"

SQL["scd2_work_orders"] = """
SELECT work_order_id, status, planned_qty, updated_at AS valid_from,
  lead(updated_at) OVER (PARTITION BY work_order_id ORDER BY updated_at) AS valid_to,
  lead(updated_at) OVER (PARTITION BY work_order_id ORDER BY updated_at) IS NULL AS is_current
FROM (SELECT *, lag(status) OVER w AS s0, lag(planned_qty) OVER w AS q0, row_number() OVER w AS rn
  FROM wolog WINDOW w AS (PARTITION BY work_order_id ORDER BY updated_at))
WHERE rn = 1 OR s0 <> status OR q0 <> planned_qty"""

SQL["scd2_from_batches"] = SQL["scd2_work_orders"]

SQL["cdc_upsert"] = SQL["cdc_apply_latest"]

_ABSENT = (
    "ch_header_chws ch_header_chwr ch_header_cdws ch_header_cdwr ch_header_chw_dpt ch_header_cw_dpt ct_outdoor_temp "
    "ct_outdoor_rh compressor_total_flow flow_consumption ch_pdt ch_hdr_supply_temp ch_hdr_return_temp"
).split()

SQL["stg_telemetry"] = f"""
SELECT time, device_id, source, building, equipment_type, device_id AS device_name, device_id AS metadata_device_id,
  topic, 'v1' AS schema_ver, msg_id, {ns('total_power', 'total_energy', 'ahu_supply_temp', 'ahu_return_temp',
  'ahu_supply_rh', 'ahu_return_rh', 'ahu_supply_flow', 'chiller_cws_temp', 'chiller_cwr_temp', 'chiller_cds_temp',
  'chiller_cdr_temp')}, {n('ahu_supply_temp', 'cooler_supply_temp')},
  {', '.join(f'NULL::DOUBLE AS {name}' for name in _ABSENT)}
FROM stg"""

SQL["stg_ahu"] = f"""
SELECT msg_id, time, device_id AS device_name, building, {ns('ahu_supply_temp', 'ahu_return_temp', 'delta_temp',
  'delta_temp_nullable')}, supply_temp_status FROM ahu"""

SQL["stg_chiller"] = f"""
SELECT msg_id, time, device_id AS device_name, building, {ns('chiller_cws_temp', 'chiller_cwr_temp', 'delta_temp',
  'delta_temp_nullable', 'delta_pct')}, supply_temp_status FROM chiller"""

SQL["stg_machines_latest"] = f"""
SELECT machine_id, machine_type, building, energy_tag, {ns('rated_power_kw')}, is_active FROM machines"""

SQL["stg_runs"] = "SELECT * FROM runs"

SQL["erp_inventory"] = """
SELECT 'machines' AS table_name, (SELECT count(*) * 2 FROM supplier) AS row_count
UNION ALL SELECT 'products', (SELECT count(*) FROM part)
UNION ALL SELECT 'shifts', (SELECT count(*) FROM region)
UNION ALL SELECT 'work_orders', (SELECT count(*) FROM wolog)"""

SQL["dim_date"] = """
SELECT d AS date_id, d AS full_date, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  CAST(isodow(d) AS INTEGER) AS day_of_week_iso, dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(year(d) AS INTEGER) AS year, CAST((month(d) - 1) // 3 + 1 AS INTEGER) AS quarter_of_year, orders_due
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS due, count(*) AS orders_due FROM orders GROUP BY 1) ON d = due"""

SQL["dim_time"] = """
SELECT CAST(m AS INTEGER) AS time_key, CAST(m // 60 AS INTEGER) AS hour_of_day, CAST(m % 60 AS INTEGER) AS minute_of_hour,
  lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS time_label,
  CASE WHEN m // 60 BETWEEN 6 AND 11 THEN 'morning' WHEN m // 60 BETWEEN 12 AND 17 THEN 'afternoon'
    WHEN m // 60 BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day, readings
FROM range(0, 1440) AS t(m)
LEFT JOIN (SELECT hour(time) * 60 + minute(time) AS seen, count(*) AS readings FROM ev GROUP BY 1) ON m = seen"""

SQL["dim_location"] = """
SELECT DISTINCT building, CASE building WHEN 'Building-Alpha' THEN 'BA' WHEN 'Building-Beta' THEN 'BB'
  WHEN 'Building-Gamma' THEN 'BG' ELSE substr(building, 10, 2) END AS building_code,
  CASE building WHEN 'Building-Alpha' THEN 1 WHEN 'Building-Beta' THEN 2 WHEN 'Building-Gamma' THEN 3 ELSE 9 END
    AS building_order, 'Facility' AS campus FROM ev"""

SQL["dim_equipment"] = """
SELECT equipment_key, id, name, equipment_type, building, building_code, energytag, bmstag, is_active,
  NULL::VARCHAR AS createdby, NULL::TIMESTAMP AS createdon, NULL::VARCHAR AS modifiedby, NULL::TIMESTAMP AS modifiedon
FROM dim_equipment"""

SQL["active_equipment"] = "SELECT equipment_key, id, name, equipment_type FROM dim_equipment WHERE is_active"

SQL["dim_machine"] = f"""
SELECT machine_key, machine_id, machine_type, building, building_code, energy_tag, {ns('rated_power_kw')},
  machine_type_order FROM dim_machine"""

SQL["dim_product"] = """
SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey AS product_id, p_name AS product_name,
  'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_type AS family, 'EA' AS uom FROM part"""

SQL["dim_work_order"] = "SELECT * FROM dim_work_order"

SQL["dim_shift"] = """
SELECT row_number() OVER (ORDER BY shift_id) AS shift_key, shift_id, shift_code, start_hour, end_hour, crew FROM shift"""

SQL["fact_hvac"] = f"""
SELECT equipment_key, date_id, time_key, time, msg_id, device_name, building, equipment_type, supply_temp_status,
  {ns('supply_temp', 'return_temp', 'supply_rh', 'return_rh', 'supply_flow', 'delta_temp', 'delta_temp_nullable',
  'cws_temp', 'cwr_temp')} FROM hvac"""

SQL["fact_hvac_long"] = f"""
SELECT equipment_key, CAST(time AS DATE) AS date_id, CAST(hour(time) * 60 + minute(time) AS INTEGER) AS time_key,
  msg_id, l.metric, {ns('reading')}, unit
FROM longm l JOIN dim_equipment e ON l.device_id = e.bmstag
LEFT JOIN profile p ON p.equipment_type = l.equipment_type AND p.metric = l.metric"""

SQL["fact_energy"] = f"""
SELECT machine_key, date_id, time_key, time, msg_id, device_id, machine_id, machine_type, building, building_code,
  energy_tag, {ns('total_power', 'total_energy', 'delta_kwh', 'delta_kwh_reset_safe')} FROM energy"""

SQL["fact_energy_bucket"] = f"""
SELECT machine_id, date_id, {n('sum(total_energy)', 'kwh')} FROM energy GROUP BY 1, 2"""

SQL["calendar_gaps"] = """
SELECT count(*) AS rows_outside_calendar FROM orders
WHERE o_orderdate < TIMESTAMP '2024-01-01' OR o_orderdate >= TIMESTAMP '2027-01-01'"""

SQL["fact_production"] = f"""
SELECT * EXCLUDE (duration_minutes), {ns('duration_minutes')} FROM production"""

SQL["fact_production_captured"] = f"""
SELECT * EXCLUDE (duration_minutes), {ns('duration_minutes')} FROM production_captured"""

SQL["fact_machine_state_captured"] = f"""
SELECT * EXCLUDE (duration_minutes), {ns('duration_minutes')} FROM machine_state_captured"""

SQL["state_intervals"] = "SELECT * FROM intervals"

SQL["fact_machine_state"] = f"""
SELECT * EXCLUDE (duration_minutes), {ns('duration_minutes')} FROM machine_state"""


def check(model: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", '{test}' AS test, "
        f"CAST(coalesce(({failures}), 0) AS BIGINT) AS failures"
    )


# Model -> its SQL view; the calendar tables are ranges.
_FROM = {
    "dim_date": "(SELECT CAST(d AS DATE) AS date_id, dayname(d) AS day_name FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY) AS t(d))",
    "dim_time": "(SELECT m AS time_key FROM range(0, 1440) AS t(m))",
    "dim_location": "(SELECT DISTINCT building, substr(building, 10, 2) AS building_code FROM ev)",
    "dim_equipment": "dim_equipment",
    "dim_machine": "dim_machine",
    "dim_product": "(SELECT p_partkey AS product_key FROM part)",
    "dim_work_order": "dim_work_order",
    "dim_shift": "(SELECT shift_id AS shift_key FROM shift)",
    "fact_hvac_reading": "hvac",
    "fact_energy_reading": "energy",
    "fact_production": "production",
    "fact_machine_state": "machine_state",
    "telemetry": "(SELECT time, device_id, kind AS value, building AS dimensions FROM ev)",
}


def null_check(model: str, column: str) -> str:
    return check(model, column, "not_null", f"SELECT count(*) FROM {_FROM[model]} WHERE {column} IS NULL")


def unique_check(model: str, column: str) -> str:
    return check(
        model, column, "unique",
        f"SELECT count(*) FROM (SELECT {column} FROM {_FROM[model]} WHERE {column} IS NOT NULL "
        f"GROUP BY 1 HAVING count(*) > 1)",
    )


def parent_check(model: str, column: str, parent: str) -> str:
    return check(
        model, column, "relationships",
        f"SELECT count(*) FROM {_FROM[model]} c WHERE {column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {_FROM[parent]} p WHERE p.{column} = c.{column})",
    )


def value_check(model: str, column: str, values: str) -> str:
    return check(
        model, column, "accepted_values",
        f"SELECT count(DISTINCT {column}) FROM {_FROM[model]} WHERE {column} NOT IN ({values})",
    )


_KEYS = [
    ("dim_date", "date_id"), ("dim_time", "time_key"), ("dim_location", "building"),
    ("dim_equipment", "equipment_key"), ("dim_equipment", "name"), ("dim_machine", "machine_key"),
    ("dim_machine", "machine_id"), ("dim_product", "product_key"), ("dim_work_order", "work_order_key"),
    ("dim_work_order", "work_order_id"), ("dim_shift", "shift_key"),
]

SQL["dq_not_null"] = " UNION ALL ".join(
    null_check(*pair)
    for pair in [
        *_KEYS, ("dim_location", "building_code"), ("fact_hvac_reading", "equipment_key"),
        ("fact_energy_reading", "machine_key"), ("fact_energy_reading", "total_power"),
        ("fact_energy_reading", "total_energy"),
    ]
)
SQL["dq_source_not_null"] = " UNION ALL ".join(
    null_check("telemetry", column) for column in ("time", "value", "dimensions", "device_id")
)
SQL["dq_unique"] = " UNION ALL ".join(unique_check(*pair) for pair in _KEYS)
SQL["dq_relationships"] = " UNION ALL ".join(
    parent_check(*triple)
    for triple in [
        ("fact_hvac_reading", "equipment_key", "dim_equipment"), ("fact_hvac_reading", "date_id", "dim_date"),
        ("fact_hvac_reading", "time_key", "dim_time"), ("fact_energy_reading", "machine_key", "dim_machine"),
        ("fact_energy_reading", "date_id", "dim_date"), ("fact_energy_reading", "time_key", "dim_time"),
        ("fact_production", "work_order_key", "dim_work_order"), ("fact_production", "machine_key", "dim_machine"),
        ("fact_machine_state", "machine_key", "dim_machine"),
    ]
)
SQL["dq_accepted_values"] = " UNION ALL ".join(
    value_check(*triple)
    for triple in [
        ("dim_date", "day_name", "'Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'"),
        ("dim_equipment", "equipment_type", "'Chiller','AHU','Cooling Tower','Air Compressor','Air Coolers'"),
        ("dim_equipment", "is_active", "true, false"),
        ("dim_machine", "machine_type", "'INJECTION_MOULDING','CNC','HEATING'"),
    ]
)
SQL["build_checks"] = " UNION ALL ".join(
    SQL[f"dq_{part}"] for part in ("not_null", "source_not_null", "unique", "relationships", "accepted_values")
)
SQL["dq_orphans"] = " UNION ALL ".join(
    [
        check("work_orders", "machine_id", "relationships",
              "SELECT count(*) FROM wolog WHERE product_id // 10 NOT IN (SELECT s_suppkey FROM supplier)"),
        check("work_orders", "product_id", "relationships",
              "SELECT count(*) FROM wolog WHERE product_id NOT IN (SELECT p_partkey FROM part)"),
        check("production_runs", "work_order_id", "relationships",
              "SELECT count(*) FROM runs WHERE work_order_id NOT IN (SELECT o_orderkey FROM orders)"),
        check("production_runs", "run_id", "unique",
              "SELECT count(*) FROM (SELECT id FROM runs GROUP BY 1 HAVING count(*) > 1)"),
        check("production_runs", "ended_at", "not_null", "SELECT count(*) FROM runs WHERE end_time IS NULL"),
        check("machines", "machine_type", "accepted_values",
              "SELECT count(DISTINCT s_suppkey % 5 < 2) FROM supplier WHERE s_suppkey % 5 < 2"),
    ]
)

SQL["dq_contract"] = """
SELECT p.equipment_type, p.metric, count(*) AS readings, count(*) FILTER (reading IS NULL) AS missing,
  count(*) FILTER (reading < setpoint - 15 OR reading > setpoint + 15) AS out_of_range,
  max(e.time) < (SELECT max(time) - INTERVAL 30 MINUTE FROM ev) AS stale
FROM ev e JOIN profile p ON e.equipment_type = p.equipment_type
LEFT JOIN longm l ON l.event_id = e.event_id AND l.metric = p.metric
GROUP BY 1, 2"""


def panel(by: str, value: str, measure: str, source: str = "stg") -> str:
    return f"""
SELECT date_trunc('minute', time) AS bucket, {by}, {measure} FROM {source}
WHERE time >= (SELECT max(time) - INTERVAL 24 HOUR FROM ev) AND {value} IS NOT NULL GROUP BY 1, 2"""


SQL["panel_supply_temp"] = panel("building", "ahu_supply_temp", avg("ahu_supply_temp", "avg_supply_temp"))
SQL["panel_return_temp"] = panel("building", "ahu_return_temp", avg("ahu_return_temp", "avg_return_temp"))
SQL["panel_chiller_dt"] = panel(
    "building", "delta_temp_nullable", avg("delta_temp_nullable", "avg_delta_temp"), "chiller"
)
SQL["panel_power_by_building"] = panel("building", "total_power", n("sum(total_power)", "total_power"))
SQL["panel_power_by_type"] = panel("equipment_type", "total_power", n("sum(total_power)", "total_power"))
SQL["panel_power_by_type_hourly"] = f"""
SELECT date_trunc('hour', time) AS bucket, equipment_type, {n('sum(total_power)', 'total_power')} FROM stg
WHERE total_power IS NOT NULL GROUP BY 1, 2"""
SQL["panel_cumulative_energy"] = f"""
SELECT date_trunc('minute', time) AS bucket, device_id AS device_name, {ns('total_energy')} FROM stg
WHERE time >= (SELECT max(time) - INTERVAL 24 HOUR FROM ev) AND total_energy IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY date_trunc('minute', time), device_id ORDER BY time DESC, msg_id DESC) = 1"""
SQL["telemetry_freshness"] = "SELECT count(*) AS readings, max(time) AS newest FROM ev"

SQL["chiller_dt_vs_power"] = f"""
SELECT name, {n('sum(gap) / sum(gn)', 'avg_chiller_delta_temp')}, {n('sum(power) / sum(pn)', 'avg_power_kw')}
FROM (SELECT equipment_key, date_trunc('day', time) AS bucket, CAST(sum(delta_temp_nullable) AS DOUBLE) AS gap,
    count(delta_temp_nullable) AS gn FROM hvac GROUP BY 1, 2) h
JOIN dim_equipment e ON h.equipment_key = e.equipment_key
JOIN (SELECT energy_tag, date_trunc('day', time) AS bucket, CAST(sum(total_power) AS DOUBLE) AS power,
    count(total_power) AS pn FROM energy GROUP BY 1, 2) p ON p.energy_tag = e.energytag AND p.bucket = h.bucket
WHERE e.equipment_type = 'Chiller' GROUP BY e.equipment_key, name
ORDER BY sum(power) / sum(pn) DESC NULLS LAST, name LIMIT 10"""

SQL["chiller_efficiency"] = f"""
SELECT e.equipment_key, name, floor(gap) AS load, count(*) AS buckets, {n('CAST(sum(CAST(power AS DECIMAL(28,12))) AS DOUBLE) / count(*)', 'avg_power_kw')},
  {n('CAST(sum(CAST(power AS DECIMAL(28,12))) AS DOUBLE) / CAST(sum(CAST(gap AS DECIMAL(28,12))) AS DOUBLE)', 'kw_per_degree')}
FROM (SELECT equipment_key, date_trunc('day', time) AS bucket,
    CAST(sum(delta_temp_nullable) AS DOUBLE) / nullif(count(delta_temp_nullable), 0) AS gap FROM hvac GROUP BY 1, 2) h
JOIN dim_equipment e ON h.equipment_key = e.equipment_key
JOIN (SELECT energy_tag, date_trunc('day', time) AS bucket,
    CAST(sum(total_power) AS DOUBLE) / nullif(count(total_power), 0) AS power FROM energy GROUP BY 1, 2) p
  ON p.energy_tag = e.energytag AND p.bucket = h.bucket
WHERE e.equipment_type = 'Chiller' AND gap > 0 AND power IS NOT NULL GROUP BY 1, 2, 3"""

SQL["kwh_per_unit_by_shift"] = f"""
SELECT coalesce(a.shift_code, b.shift_code) AS shift_code, {n('coalesce(kwh, 0)', 'total_kwh')},
  CAST(coalesce(units, 0) AS BIGINT) AS total_units, {n('CAST(kwh AS DOUBLE) / nullif(units, 0)', 'kwh_per_unit')}
FROM (SELECT shift_code, sum(delta_kwh_reset_safe) AS kwh FROM {shifted('energy', 'time')} GROUP BY 1) a
FULL JOIN (SELECT shift_code, sum(good_qty) AS units FROM {shifted('runs', 'start_time')} GROUP BY 1) b
  ON a.shift_code = b.shift_code"""

_DEMAND = """(SELECT building, minute, round(sum(power), 6) AS power FROM (
  SELECT building, device_id, date_trunc('minute', time) AS minute, CAST(sum(total_power) AS DOUBLE) / count(total_power) AS power
  FROM energy WHERE total_power IS NOT NULL GROUP BY ALL) GROUP BY 1, 2)"""
SQL["demand_peak_by_shift"] = f"""
SELECT building, shift_date, shift_code, {n('power', 'peak_power')}, minute AS peak_time
FROM {shifted(_DEMAND, 'minute')} WHERE power IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY building, shift_date, shift_code ORDER BY power DESC, minute) = 1"""

SQL["energy_by_building"] = f"""
SELECT building, machine_type, date_id, {n('sum(delta_kwh_reset_safe)', 'kwh')}, {avg('total_power', 'avg_power')},
  {n('max(total_power)', 'max_power')} FROM energy GROUP BY 1, 2, 3"""

SQL["energy_by_state"] = f"""
SELECT machine_id, state, count(*) AS readings, {n('sum(delta_kwh_reset_safe)', 'kwh')}, {avg('total_power', 'avg_power')}
FROM (SELECT e.machine_id, e.time, e.total_power, e.delta_kwh_reset_safe, i.state
  FROM energy e JOIN intervals i
  ON e.machine_id = i.machine_id AND e.time >= i.start_time AND (i.end_time IS NULL OR e.time < i.end_time)) GROUP BY 1, 2"""

SQL["asof_hvac_energy"] = f"""
SELECT h.energytag, h.msg_id, h.reading_time, {n('h.delta_temp_nullable', 'delta_temp_nullable')},
  p.time AS energy_time, {n('p.total_power', 'total_power')}
FROM (SELECT energytag, msg_id, time AS reading_time, delta_temp_nullable
  FROM hvac JOIN dim_equipment e USING (equipment_key)) h
ASOF LEFT JOIN (SELECT energy_tag, time, total_power FROM energy
  QUALIFY row_number() OVER (PARTITION BY energy_tag, time ORDER BY msg_id DESC) = 1) p
ON h.energytag = p.energy_tag AND h.reading_time >= p.time"""

SQL["oee"] = f"""
SELECT machine_id, date_id, {n('av', 'availability')}, {n('pe', 'performance')}, {n('qu', 'quality')}, {n('av * pe * qu', 'oee')}
FROM (SELECT coalesce(s.machine_id, r.machine_id) AS machine_id, coalesce(s.date_id, r.date_id) AS date_id,
  CAST(coalesce(run_hours, 0) AS DOUBLE) / nullif(CAST(state_hours AS DOUBLE), 0) AS av,
  CAST(total AS DOUBLE) / nullif(CAST(run_minutes AS DOUBLE), 0) AS pe,
  CAST(good AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0) AS qu
FROM (SELECT machine_id, CAST(start_time AS DATE) AS date_id,
    sum(CAST((epoch_us(end_time) - epoch_us(start_time)) / 3600e6 AS DECIMAL(28,12))) AS state_hours,
    sum(CASE WHEN state = 'RUN' THEN CAST((epoch_us(end_time) - epoch_us(start_time)) / 3600e6 AS DECIMAL(28,12)) END)
      AS run_hours
  FROM intervals WHERE end_time IS NOT NULL GROUP BY 1, 2) s
FULL JOIN (SELECT machine_id, CAST(start_time AS DATE) AS date_id, sum(good_qty) AS good, sum(total_qty) AS total,
    sum(CAST((epoch_us(end_time) - epoch_us(start_time)) / 60e6 AS DECIMAL(28,12))) AS run_minutes
  FROM runs GROUP BY 1, 2) r ON s.machine_id = r.machine_id AND s.date_id = r.date_id)"""

SQL["schedule"] = """
SELECT w.*, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS product_name, machine_type, building
FROM wo w JOIN part ON p_partkey = product_id JOIN machines m ON m.machine_id = w.machine_id"""

SQL["machine_list"] = SQL["stg_machines_latest"]

SQL["run_shift"] = f"""
SELECT shift_date, shift_code, count(*) AS runs, CAST(sum(good_qty) AS BIGINT) AS good_qty,
  CAST(sum(scrap_qty) AS BIGINT) AS scrap_qty FROM {shifted('runs', 'start_time')} GROUP BY 1, 2"""

SQL["hvac_vs_production"] = f"""
SELECT building, hour, {ns('avg_delta_temp', 'machine_power', 'kwh')}, CAST(units AS BIGINT) AS units
FROM (SELECT building, date_trunc('hour', time) AS hour, {avg('delta_temp_nullable', 'avg_delta_temp')} FROM hvac GROUP BY 1, 2)
FULL JOIN (SELECT building, date_trunc('hour', time) AS hour, sum(total_power) AS machine_power,
  sum(delta_kwh_reset_safe) AS kwh FROM energy GROUP BY 1, 2) USING (building, hour)
FULL JOIN (SELECT building, date_trunc('hour', start_time) AS hour, sum(good_qty) AS units
  FROM runs JOIN dim_machine m USING (machine_id) GROUP BY 1, 2) USING (building, hour)"""

_ROLL = """CAST(sum(readings) AS BIGINT) AS readings, round(CAST(sum(power_sum) AS DOUBLE), 6) AS power_sum,
  round(CAST(min(power_min) AS DOUBLE), 6) AS power_min, round(CAST(max(power_max) AS DOUBLE), 6) AS power_max,
  round(CAST(sum(kwh) AS DOUBLE), 6) AS kwh,
  round(CAST(sum(power_sum) AS DOUBLE) / nullif(CAST(sum(readings) AS DOUBLE), 0), 6) AS power_avg"""
SQL["rollup_minute"] = f"SELECT device_id, bucket, {_ROLL} FROM minute_roll GROUP BY 1, 2"
SQL["rollup_hour"] = f"SELECT device_id, date_trunc('hour', bucket) AS bucket, {_ROLL} FROM minute_roll GROUP BY 1, 2"

SQL["rollup_incremental"] = SQL["rollup_hour"]

SQL["energy_integrate"] = f"SELECT device_id, time, msg_id, {ns('total_power', 'added_kwh', 'total_kwh')} FROM integrated"
SQL["stream_energy"] = f"SELECT device_id, time, msg_id, {ns('total_power', 'total_kwh')} FROM integrated"

SQL["stream_energy_state"] = SQL["stream_energy"]
SQL["build_incremental"] = f"""
SELECT f.*, {n('i.total_kwh', 'total_kwh')} FROM ({SQL['fact_energy']}) f JOIN integrated i USING (device_id, msg_id)"""

SQL["anomaly_power_spike"] = f"""
SELECT device_id, time, msg_id, {n('total_power', 'total_power')}, {n('mean', 'baseline')}, {n('z', 'z_score')}
FROM (SELECT *, (CAST(total_power AS DOUBLE) - mean) / CASE WHEN deviation > abs(mean) * 1e-12 THEN deviation END AS z
  FROM (SELECT *, sm / cnt AS mean FROM (
    SELECT device_id, time, msg_id, total_power, count(*) OVER w AS cnt, CAST(sum(total_power) OVER w AS DOUBLE) AS sm,
      stddev_pop(CAST(total_power AS DOUBLE)) OVER w AS deviation
    FROM stg WHERE source = 'ems' AND total_power IS NOT NULL
    WINDOW w AS (PARTITION BY device_id ORDER BY time, msg_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
  WHERE cnt = 10)) WHERE abs(z) > 3"""

SQL["late_audit"] = """
SELECT arrival, time, newest FROM (
  SELECT *, max(time) OVER (ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS newest FROM (
    SELECT event_id AS arrival, time - CASE WHEN event_id % 13 = 0 THEN INTERVAL 2 MINUTE ELSE INTERVAL 0 MINUTE END AS time
    FROM ev)) WHERE time < newest - INTERVAL 30 SECOND"""

SQL["stream_late_audit"] = SQL["late_audit"]

SQL["state_transition_check"] = """
SELECT id, machine_id, previous_state, state, previous_state IS NULL OR (previous_state = 'RUN')
  OR (previous_state = 'IDLE' AND state IN ('IDLE', 'RUN')) OR (previous_state = 'DOWN' AND state IN ('DOWN', 'IDLE'))
  AS allowed
FROM (SELECT *, lag(state) OVER (PARTITION BY machine_id ORDER BY start_time, id) AS previous_state FROM states)"""

SQL["stuck_value"] = """
SELECT device_id, level AS stuck_at, count(*) AS rows, min(time) AS first_time, max(time) AS last_time
FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY time, event_id)
    - row_number() OVER (PARTITION BY device_id, level ORDER BY time, event_id) AS island
  FROM (SELECT device_id, time, event_id, CAST(k // 34 AS BIGINT) AS level FROM ev))
GROUP BY device_id, level, island HAVING count(*) >= 3"""

SQL["setpoint_deviation"] = f"""
SELECT device_id, l.equipment_type, l.metric, unit, count(*) AS readings, {avg('gap', 'mean_deviation')},
  {n('max(abs(gap))', 'max_deviation')}
FROM (SELECT l.*, unit, CAST(reading - CAST(setpoint AS DOUBLE) AS DECIMAL(28,12)) AS gap FROM longm l
  JOIN profile p ON p.equipment_type = l.equipment_type AND p.metric = l.metric) l
GROUP BY 1, 2, 3, 4"""

SQL["low_delta"] = f"""
SELECT msg_id, equipment_type, {ns('delta_temp_nullable')}, nominal_delta FROM (
  SELECT msg_id, equipment_type, delta_temp_nullable, 11.0::DOUBLE AS nominal_delta FROM ahu
  UNION ALL SELECT msg_id, equipment_type, delta_temp_nullable, 7.0::DOUBLE FROM chiller)
WHERE delta_temp_nullable < nominal_delta * 0.5"""

SQL["device_catalog"] = "SELECT * FROM catalog"
SQL["metric_calibration"] = f"""
SELECT device_id, metric, {ns('lo', 'hi')}, {n('(lo + hi) / 2', 'nominal')} FROM calibration"""
SQL["device_metric_counts"] = """
SELECT c.device_id, CAST(metrics AS INTEGER) AS metrics, first_metric
FROM catalog c LEFT JOIN (SELECT device_id, count(*) AS metrics, min(metric) AS first_metric FROM calibration GROUP BY 1) m
  ON m.device_id = c.device_id"""
SQL["fleet_expand"] = """
SELECT printf('%s-%s-%02d', building_code, code, CAST(number AS INTEGER)) AS machine_id, machine_type, building,
  printf('%s-%s-%02d', building_code, code, CAST(number AS INTEGER)) AS energy_tag, idle_kw, rated_power_kw, nominal_kw, topic
FROM (SELECT building_code, building, f.machine_type, row_number() OVER (PARTITION BY building, f.machine_type) AS number,
    code, idle_kw, rated_power_kw, nominal_kw, topic
  FROM (SELECT building_code, building, machine_type FROM dim_machine) f JOIN (VALUES
    ('INJECTION_MOULDING', 'IMM', 8.0::DOUBLE, 140.0::DOUBLE, 75.0::DOUBLE, 'ems.machine.injection_moulding'),
    ('CNC', 'CNC', 2.0::DOUBLE, 35.0::DOUBLE, 15.0::DOUBLE, 'ems.machine.cnc'),
    ('HEATING', 'HEAT', 10.0::DOUBLE, 220.0::DOUBLE, 120.0::DOUBLE, 'ems.machine.heating'))
    AS t(machine_type, code, idle_kw, rated_power_kw, nominal_kw, topic) ON t.machine_type = f.machine_type)"""


def single(high: str, low: str) -> str:
    """Single stored in two words; the fixture has normal numbers only."""
    return (
        f"(CASE WHEN {high} >= 32768 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"
        f" * (1.0::DOUBLE + (({high}) % 128 * 65536 + {low})::DOUBLE / 8388608.0::DOUBLE)"
        f" * pow(2.0::DOUBLE, ((({high}) // 128) % 256 - 127)::DOUBLE))"
    )


SQL["register_decode"] = f"""
SELECT event_id, {n(single('k * 3 + 16000', 'event_id % 65536'), 'total_power')},
  {n(single('k + 49000', 'event_id * 7 % 65536'), 'total_energy')} FROM ev"""

SQL["register_round_trip"] = f"""
SELECT msg_id, metric, {n('CAST(reading AS FLOAT)', 'first')}, {n('CAST(-reading / 3 AS FLOAT)', 'second')} FROM longm"""

SQL["ingest_stream"] = f"""
SELECT l.msg_id, l.time, CAST(l.time AS DATE) AS date, l.device_id, source, metric, {n('reading', 'reading')}
FROM longm l JOIN ev ON ev.msg_id = l.msg_id"""

SQL["raw_live"] = SQL["ingest_stream"]
SQL["ingest_replayed"] = SQL["ingest_stream"]

SQL["stream_outages"] = """
SELECT device_id, equipment_type, min(time) AS first_time, max(time) AS last_time, max(time) + INTERVAL 1 DAY AS silent_from,
  count(*) AS readings
FROM (SELECT *, sum(CASE WHEN before IS NULL OR time > before + INTERVAL 1 DAY THEN 1 ELSE 0 END)
    OVER (PARTITION BY device_id ORDER BY time, event_id ROWS UNBOUNDED PRECEDING) AS session
  FROM (SELECT *, lag(time) OVER (PARTITION BY device_id ORDER BY time, event_id) AS before FROM (
    SELECT device_id, equipment_type, time, event_id FROM ev
    WHERE NOT (CAST(substr(device_id, 3) AS BIGINT) % 3 = 0 AND day(time) BETWEEN 10 AND 12))))
GROUP BY device_id, equipment_type, session
HAVING max(time) + INTERVAL 1 DAY <= (SELECT max(time) - INTERVAL 30 SECOND FROM ev
  WHERE NOT (CAST(substr(device_id, 3) AS BIGINT) % 3 = 0 AND day(time) BETWEEN 10 AND 12))"""

SQL["stream_tumbling"] = f"""
SELECT device_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(total_power) AS readings,
  {n('sum(total_power)', 'power_sum')}, {n('min(total_power)', 'power_min')}, {n('max(total_power)', 'power_max')}
FROM (SELECT *, date_trunc('hour', time) AS window_start FROM stg WHERE source = 'ems')
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(time) - INTERVAL 30 SECOND FROM ev WHERE source = 'ems')
GROUP BY 1, 2"""

SQL["stream_dedup"] = "SELECT msg_id, time, device_id FROM ev"


def all_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in SQL.items()}
