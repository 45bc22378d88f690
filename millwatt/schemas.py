"""Table shapes, written as DDL strings that Spark parses. The plant's contract names them."""

from __future__ import annotations

TELEMETRY_EVENT = (
    "deviceId string, source string, equipmentType string, building string, "
    "ts_utc bigint, value map<string,double>, metadata map<string,string>"
)

# The same record as JSON text: members stay text so one bad member does not lose the others.
TELEMETRY_TEXT_EVENT = (
    "deviceId string, source string, equipmentType string, building string, "
    "ts_utc bigint, value map<string,string>, metadata map<string,string>"
)

RAW_TELEMETRY = (
    "time timestamp, value map<string,double>, dimensions map<string,string>, "
    "metadata map<string,string>, device_id string, source string, date date"
)

MACHINE_MASTER = (
    "id int, name string, type string, building string, buildingCode string, "
    "energyTag string, bmsTag string, isactive string, createdby string, "
    "createdon timestamp, modifiedby string, modifiedon timestamp"
)

SAMPLE_BMS = "timebucket string, name string, building string, equipmentType string, value string"

SAMPLE_EMS = (
    "timebucket string, name string, building string, "
    "totalEnergy decimal(18,8), totalPower decimal(18,8)"
)

# Change columns added to every captured row.
CHANGE_COLUMNS = "__op string, __source_ts_ms bigint, __lsn bigint, __deleted string"

ERP_TABLES = {
    "products": "product_id int, sku string, name string, family string, uom string, "
    "created_at timestamp",
    "machines": "machine_id string, machine_type string, building string, energy_tag string, "
    "rated_power_kw decimal(8,2), is_active boolean, created_at timestamp",
    "shifts": "shift_id int, shift_code string, start_hour int, end_hour int, crew string",
    "work_orders": "work_order_id int, order_no string, product_id int, machine_id string, "
    "planned_qty int, due_date date, status string, created_at timestamp, updated_at timestamp",
    "production_runs": "run_id int, work_order_id int, machine_id string, good_qty int, "
    "scrap_qty int, started_at timestamp, ended_at timestamp, created_at timestamp",
    "machine_states": "state_id int, machine_id string, state string, started_at timestamp, "
    "ended_at timestamp",
}

ERP_KEYS = {
    "products": ["product_id"],
    "machines": ["machine_id"],
    "shifts": ["shift_id"],
    "work_orders": ["work_order_id"],
    "production_runs": ["run_id"],
    "machine_states": ["state_id"],
}

# Avro record of one event; the reader does not look at the namespace.
TELEMETRY_AVRO = """
{"type": "record", "name": "Telemetry", "fields": [
  {"name": "deviceId", "type": "string"},
  {"name": "source", "type": "string"},
  {"name": "equipmentType", "type": "string"},
  {"name": "building", "type": "string"},
  {"name": "ts_utc", "type": {"type": "long", "logicalType": "timestamp-millis"}},
  {"name": "value", "type": {"type": "map", "values": "double"}},
  {"name": "metadata", "type": {"type": "map", "values": "string"}}]}
"""
