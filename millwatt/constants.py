"""Values fixed by the plant's data contract; results depend on them being exactly these."""

from __future__ import annotations

# HVAC equipment types on the wire and the topic each is published to.
BMS_TOPICS = {
    "AHU": "bms.hvac.ahu",
    "Chillers": "bms.hvac.chiller",
    "Chiller MainHeader": "bms.hvac.chiller_header",
    "CoolingTower MainHeader": "bms.hvac.cooling_tower",
    "Air Compressors": "bms.hvac.air_compressor",
    "Air Coolers": "bms.hvac.air_cooler",
}

# Production machine types and the topic each is published to.
EMS_TOPICS = {
    "INJECTION_MOULDING": "ems.machine.injection_moulding",
    "CNC": "ems.machine.cnc",
    "HEATING": "ems.machine.heating",
}

# Machine types in report order.
MACHINE_TYPE_ORDER = {"INJECTION_MOULDING": 1, "CNC": 2, "HEATING": 3}

# Short codes used in machine ids.
MACHINE_TYPE_CODE = {"INJECTION_MOULDING": "IMM", "CNC": "CNC", "HEATING": "HEAT"}

# Asset types of the HVAC master that become equipment.
EQUIPMENT_TYPES = ("Chiller", "AHU", "Cooling Tower", "Air Compressor", "Air Coolers")

# Known buildings, their code and report order.
BUILDINGS = {
    "Building-Alpha": ("BA", 1),
    "Building-Beta": ("BB", 2),
    "Building-Gamma": ("BG", 3),
}
OTHER_BUILDING_ORDER = 9
CAMPUS = "Facility"

# Inclusive supply temperature bands that count as OK.
AHU_SUPPLY_BAND = (10, 20)
CHILLER_SUPPLY_BAND = (4, 12)

# Day part by first and last hour; other hours are night.
DAY_PARTS = {"morning": (6, 11), "afternoon": (12, 17), "evening": (18, 21)}
OTHER_DAY_PART = "night"

# First and last day of the default calendar.
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2026-12-31"

# Staging column -> key of the reading map, in staging order.
METRIC_COLUMNS = {
    "total_power": "totalPower",
    "total_energy": "totalEnergy",
    "ahu_supply_temp": "Supply_Temp",
    "ahu_return_temp": "Return_Temp",
    "ahu_supply_rh": "Supply_RH",
    "ahu_return_rh": "Return_RH",
    "ahu_supply_flow": "Supply_Flow",
    "chiller_cws_temp": "Chilled_Water_Supply_Temp",
    "chiller_cwr_temp": "Chilled_Water_Return_Temp",
    "chiller_cds_temp": "Condensor_Supply_Temp",
    "chiller_cdr_temp": "Condensor_Return_Temp",
    "ch_header_chws": "CHWS_Temp",
    "ch_header_chwr": "CHWR_Temp",
    "ch_header_cdws": "CDWS_Temp",
    "ch_header_cdwr": "CDWR_Temp",
    "ch_header_chw_dpt": "CHW_DPT",
    "ch_header_cw_dpt": "CW_DPT",
    "ct_outdoor_temp": "Outdoor_MIT_01_Temp",
    "ct_outdoor_rh": "Outdoor_MIT_01_RH",
    "cooler_supply_temp": "Supply_Temp",
    "compressor_total_flow": "Total_Flow",
    "flow_consumption": "consumptionFlowRate",
    "ch_pdt": "CHW_PDT",
    "ch_hdr_supply_temp": "Chiller_Header_Supply_Temp",
    "ch_hdr_return_temp": "Chiller_Header_Return_Temp",
}

# Fixed values: (equipment type, metric key, unit, setpoint) of the HVAC profiles.
PROFILE_METRICS = (
    ("Chillers", "Chilled_Water_Supply_Temp", "°C", 7.0),
    ("Chillers", "Chilled_Water_Return_Temp", "°C", 14.0),
    ("Chillers", "Condensor_Supply_Temp", "°C", 29.0),
    ("Chillers", "Condensor_Return_Temp", "°C", 32.0),
    ("AHU", "Supply_Temp", "°C", 14.0),
    ("AHU", "Return_Temp", "°C", 25.0),
    ("AHU", "Supply_RH", "%", 58.0),
    ("AHU", "Return_RH", "%", 55.0),
    ("AHU", "Supply_Flow", "L/s", 1000.0),
    ("CoolingTower MainHeader", "Outdoor_MIT_01_Temp", "°C", 30.0),
    ("CoolingTower MainHeader", "Outdoor_MIT_01_RH", "%", 65.0),
    ("Chiller MainHeader", "CHWS_Temp", "°C", 7.0),
    ("Chiller MainHeader", "CHWR_Temp", "°C", 12.0),
    ("Chiller MainHeader", "CDWS_Temp", "°C", 30.0),
    ("Chiller MainHeader", "CDWR_Temp", "°C", 35.0),
    ("Chiller MainHeader", "CHW_DPT", "kPa", 250.0),
    ("Chiller MainHeader", "CW_DPT", "kPa", 200.0),
    ("Chiller MainHeader", "consumptionFlowRate", "L/s", 500.0),
    ("Chiller MainHeader", "CHW_PDT", "°C", 5.0),
    ("Air Compressors", "Total_Flow", "m³/min", 500.0),
    ("Air Coolers", "Supply_Temp", "°C", 14.0),
)

# Nominal supply-to-return difference by equipment type.
NOMINAL_DELTA = {"Chillers": 7.0, "AHU": 11.0, "Chiller MainHeader": 5.0}

# Idle, peak and nominal power in kW by machine type.
POWER_ENVELOPE = {
    "INJECTION_MOULDING": (8.0, 140.0, 75.0),
    "CNC": (2.0, 35.0, 15.0),
    "HEATING": (10.0, 220.0, 120.0),
}

# Days kept uncompacted, days kept at all, seconds a reading may be late.
COMPACT_AFTER_DAYS = 7
RETAIN_DAYS = 90
LATENESS_SECONDS = 30

# Pattern of telemetry topics and of change-log topics.
TELEMETRY_TOPIC_PATTERN = r"(bms|ems)\..*"
CHANGE_TOPIC_PATTERN = r"erp\.public\.(.*)"

# An event time further ahead of the clock than this is not believed.
LARGEST_CLOCK_LEAD = "1 DAY"
