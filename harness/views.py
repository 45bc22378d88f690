"""The given tables seen as plant tables; the mapping is the same as in ``sql_views``."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt.functions import labels
from millwatt.operators import dims, facts, landing, registry, signals, staging
from millwatt.session import configure, work_folder

DEVICE_TYPES = ("AHU", "Chillers", "INJECTION_MOULDING", "CNC", "HEATING")
BUILDINGS = ("Building-Alpha", "Building-Beta", "Building-Gamma", "Building-Delta")


def pick(number: Column, names: tuple) -> Column:
    """Name by ``number`` modulo the count of names."""
    return labels.lookup(number % len(names), dict(enumerate(names)))


def device_tag(number: Column) -> Column:
    return F.concat(F.lit("D-"), F.lpad(number.cast("string"), 6, "0"))


def known_values(readings: dict[str, Column]) -> Column:
    """Map of the readings that are not null."""
    none = F.expr("cast(map() as map<string,double>)")
    return F.map_concat(
        *[F.when(v.isNotNull(), F.create_map(F.lit(k), v)).otherwise(none) for k, v in readings.items()]
    )


def plant_events(events: DataFrame) -> DataFrame:
    """Wire records from event rows; works on a stream as well."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("user_id") % 5
    time = F.col("ts").cast("timestamp")
    base = events.select(
        "event_id",
        "event_type",
        "user_id",
        "value",
        k.alias("k"),
        device_tag(F.col("user_id")).alias("deviceId"),
        F.when(kind < 2, "bms").otherwise("ems").alias("source"),
        pick(F.col("user_id"), DEVICE_TYPES).alias("equipmentType"),
        pick(F.col("user_id"), BUILDINGS).alias("building"),
        F.unix_millis(time).alias("ts_utc"),
    )
    reading, k = F.col("value"), F.col("k")
    supply = F.when(k % 17 != 0, reading / 10)
    back = F.when(k % 19 != 0, k / F.lit(3.0))
    air = {
        "Supply_Temp": supply,
        "Return_Temp": back,
        "Supply_RH": k.cast("double"),
        "Return_RH": k / F.lit(2.0),
        "Supply_Flow": F.when(F.col("event_type") == "view", reading),
    }
    water = {
        "Chilled_Water_Supply_Temp": supply - 1.0,
        "Chilled_Water_Return_Temp": back,
        "Condensor_Supply_Temp": k / F.lit(10.0) + 27,
        "Condensor_Return_Temp": k / F.lit(10.0) + 30,
    }
    machine = {
        "totalPower": F.when(k % 23 != 0, reading),
        "totalEnergy": F.col("event_id") / F.lit(4.0) + reading / 100,
    }
    kind = F.col("user_id") % 5
    values = (
        F.when(kind == 0, known_values(air))
        .when(kind == 1, known_values(water))
        .otherwise(known_values(machine))
    )
    metadata = F.create_map(
        F.lit("msgId"), F.col("event_id").cast("string"),
        F.lit("deviceId"), F.col("deviceId"),
        F.lit("source"), F.col("source"),
        F.lit("topic"), labels.topic(F.col("source"), F.col("equipmentType")),
        F.lit("schema_ver"), F.lit("v1"),
    )
    return base.withColumns({"value": values, "metadata": metadata})


class Views:
    """Plant tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a stream of files; as a pattern the path may be one file or a folder."""
        schema = self.table(name).schema
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}.parque[t]")

    @cached_property
    def events(self) -> DataFrame:
        return plant_events(self.table("events"))

    @cached_property
    def raw(self) -> DataFrame:
        return landing.land(self.events)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.telemetry(self.raw)

    @cached_property
    def master(self) -> DataFrame:
        key = F.col("s_suppkey")
        types = ("AHU", "Chiller", "Cooling Tower", "Pumps", "Air Compressor")
        building = pick(key, BUILDINGS)
        return self.table("supplier").select(
            key.alias("id"),
            F.col("s_name").alias("name"),
            pick(key, types).alias("type"),
            building.alias("building"),
            labels.building_code(building).alias("buildingCode"),
            device_tag(key + 2).alias("energyTag"),
            F.when(key % 5 < 2, device_tag(key)).otherwise(F.lit("NULL")).alias("bmsTag"),
            pick(F.col("s_nationkey"), ("1", "true", "f")).alias("isactive"),
            F.lit(None).cast("string").alias("createdby"),
            F.lit(None).cast("timestamp").alias("createdon"),
            F.lit(None).cast("string").alias("modifiedby"),
            F.lit(None).cast("timestamp").alias("modifiedon"),
        )

    @cached_property
    def machines_raw(self) -> DataFrame:
        """Two captured versions of every machine."""
        key = F.col("s_suppkey")
        types = ("HVAC", "HVAC", "INJECTION_MOULDING", "CNC", "HEATING")
        versions = self.table("supplier").withColumn("version", F.explode(F.array(F.lit(0), F.lit(1))))
        return versions.select(
            device_tag(key).alias("machine_id"),
            pick(key, types).alias("machine_type"),
            pick(key, BUILDINGS).alias("building"),
            device_tag(key).alias("energy_tag"),
            (F.floor(F.col("s_acctbal") / 100) + F.col("version")).cast("decimal(8,2)").alias("rated_power_kw"),
            (F.col("s_acctbal") > 0).alias("is_active"),
            (key * 10 + F.col("version")).alias("__source_ts_ms"),
        )

    @cached_property
    def products_raw(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("product_id"),
            F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("family"),
            F.lit("EA").alias("uom"),
        )

    @cached_property
    def shifts_raw(self) -> DataFrame:
        """Five shifts that cover the day, the first past midnight."""
        key = F.col("r_regionkey")
        return self.table("region").select(
            key.alias("shift_id"),
            F.chr(F.lit(65) + key).alias("shift_code"),
            ((key * 5 + 22) % 24).alias("start_hour"),
            F.when(key == 4, 22).otherwise((key * 5 + 27) % 24).alias("end_hour"),
            F.col("r_name").alias("crew"),
        )

    @cached_property
    def work_order_log(self) -> DataFrame:
        """Three captured versions of every work order: planned, at its status, reviewed."""
        versions = self.table("orders").withColumn(
            "version", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
        )
        version = F.col("version")
        status = (
            F.when(version == 0, "PLANNED")
            .when(F.col("o_orderstatus") == "P", "RELEASED")
            .when(F.col("o_orderstatus") == "O", "RUNNING")
            .otherwise("DONE")
        )
        planned = F.floor(F.col("o_totalprice") / 1000).cast("int")
        reviewed = F.when((version == 2) & (F.col("o_custkey") % 2 == 0), planned + 10).otherwise(planned)
        shift = F.when(version == 0, -72).when(version == 1, 0).otherwise(24)
        return versions.select(
            F.col("o_orderkey").alias("work_order_id"),
            F.concat(F.lit("WO-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("order_no"),
            F.col("o_custkey").alias("product_id"),
            device_tag(F.expr("o_custkey div 10")).alias("machine_id"),
            reviewed.alias("planned_qty"),
            F.to_date("o_orderdate").alias("due_date"),
            status.alias("status"),
            (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=shift)).alias("updated_at"),
            version.alias("version"),
        )

    @cached_property
    def work_orders(self) -> DataFrame:
        return staging.work_orders(self.work_order_log)

    @cached_property
    def runs_raw(self) -> DataFrame:
        """Runs in January 2024, so they meet the telemetry."""
        start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(
            (F.col("l_orderkey") % 30).cast("int"),
            (F.col("l_partkey") % 24).cast("int"),
            F.col("l_linenumber") * 7,
        )
        unfinished = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
        minutes = F.col("l_quantity").cast("int")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("run_id"),
            F.col("l_orderkey").alias("work_order_id"),
            device_tag(F.col("l_suppkey")).alias("machine_id"),
            minutes.alias("good_qty"),
            F.round(F.col("l_discount") * 100).cast("int").alias("scrap_qty"),
            start.alias("started_at"),
            F.when(~unfinished, start + F.make_dt_interval(mins=minutes)).alias("ended_at"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        return staging.production_runs(self.runs_raw)

    @staticmethod
    def _captured(rows: DataFrame, key: str, gone: int, **before) -> DataFrame:
        """Change rows: a first one with the values ``before``, the row as it is, and for some keys a delete."""
        log = rows.withColumn("__lsn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))))
        log = log.where((F.col("__lsn") < 2) | (F.col(key) % gone == 0))
        early = {name: F.when(F.col("__lsn") > 0, F.col(name)).otherwise(value) for name, value in before.items()}
        op = F.element_at(F.array(F.lit("c"), F.lit("u"), F.lit("d")), F.col("__lsn").cast("int") + 1)
        return log.withColumns({**early, "__op": op, "__source_ts_ms": F.floor(F.col("__lsn") / 2), "__deleted": (op == "d").cast("string")})

    @cached_property
    def runs_log(self) -> DataFrame:
        """A run of every order as captured: begun, finished, and for every tenth removed."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((key % 30).cast("int"), (customer % 24).cast("int"))
        runs = self.table("orders").select(
            key.alias("run_id"),
            key.alias("work_order_id"),
            device_tag(F.expr("o_custkey div 10")).alias("machine_id"),
            (customer % 90).cast("int").alias("good_qty"),
            (customer % 7).cast("int").alias("scrap_qty"),
            start.alias("started_at"),
            (start + F.make_dt_interval(mins=(key % 50 + 1).cast("int"))).alias("ended_at"),
        )
        return self._captured(runs, "run_id", 10, good_qty=F.lit(0), scrap_qty=F.lit(None), ended_at=F.lit(None))

    @cached_property
    def states_log(self) -> DataFrame:
        """The states as captured: begun, ended where that is recorded, and every eleventh removed."""
        return self._captured(self.states_raw, "state_id", 11, ended_at=F.lit(None))

    @cached_property
    def states_raw(self) -> DataFrame:
        """A state begins with every event; only breakdowns have a recorded end."""
        kind = F.col("event_type")
        start = F.timestamp_millis("ts_utc")
        return self.events.select(
            F.col("event_id").alias("state_id"),
            F.col("deviceId").alias("machine_id"),
            F.when(kind.isin("purchase", "view"), "RUN")
            .when(kind.isin("click", "signup"), "IDLE")
            .otherwise("DOWN")
            .alias("state"),
            start.alias("started_at"),
            F.when(kind == "error", start + F.expr("INTERVAL 30 MINUTES")).alias("ended_at"),
        )

    @cached_property
    def states(self) -> DataFrame:
        return staging.machine_states(self.states_raw)

    @cached_property
    def intervals(self) -> DataFrame:
        return facts.state_intervals(self.states)

    @cached_property
    def change_log(self) -> DataFrame:
        return self.change_envelopes(self.table("events"))

    @staticmethod
    def change_envelopes(events: DataFrame) -> DataFrame:
        """Change envelopes: an event changes the device's row, an error deletes it."""
        image = F.struct(
            F.col("user_id").alias("device_no"),
            F.col("event_type").alias("status"),
            F.col("value").alias("amount"),
        )
        op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
        ts = F.col("ts").cast("timestamp")
        return events.select(
            op.alias("op"),
            F.when(op != "c", image).alias("before"),
            F.when(op != "d", image).alias("after"),
            F.struct(
                (F.floor(F.unix_millis(ts) / 60000) * 60000).alias("ts_ms"),
                F.col("event_id").alias("lsn"),
            ).alias("source"),
            F.concat(
                F.lit("erp.public."),
                labels.lookup(
                    F.col("event_type"),
                    {
                        "purchase": "production_runs",
                        "view": "machine_states",
                        "click": "work_orders",
                        "signup": "products",
                        "error": "machines",
                    },
                ),
            ).alias("topic"),
        )

    @cached_property
    def erp(self) -> dict[str, DataFrame]:
        return {
            "machines": self.machines_raw,
            "products": self.products_raw,
            "shifts": self.shifts_raw,
            "work_orders": self.work_order_log,
            "production_runs": self.runs_raw,
            "machine_states": self.states_raw,
        }

    # Dimensions and facts.

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.calendar(self.spark)

    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.minutes(self.spark)

    @cached_property
    def dim_equipment(self) -> DataFrame:
        return dims.equipment(self.master)

    @cached_property
    def dim_machine(self) -> DataFrame:
        return dims.machine(staging.machines(self.machines_raw))

    @cached_property
    def dim_work_order(self) -> DataFrame:
        return dims.work_order(self.work_orders)

    @cached_property
    def hvac(self) -> DataFrame:
        return facts.hvac(
            staging.ahu(self.stg), staging.chiller(self.stg), self.dim_equipment, self.dim_date, self.dim_time
        )

    @cached_property
    def readings(self) -> DataFrame:
        """Machine readings in fact form, without differences."""
        return facts.machine_readings(
            staging.machine_readings(self.stg), self.dim_machine, self.dim_date, self.dim_time
        )

    @cached_property
    def energy(self) -> DataFrame:
        return facts.energy(self.stg, self.dim_machine, self.dim_date, self.dim_time)

    def written(self, name: str) -> DataFrame:
        """A view as a written table, as the model build leaves it for the queries after it."""
        df = getattr(self, name)
        path = work_folder(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def production(self) -> DataFrame:
        return facts.production(self.dim_work_order, self.dim_machine, self.runs)

    @cached_property
    def profiles(self) -> DataFrame:
        return signals.profile_metrics(self.spark)

    @cached_property
    def fleet(self) -> DataFrame:
        """How many machines of each type every building has."""
        return self.dim_machine.groupBy("building", "machine_type").agg(
            F.count(F.lit(1)).alias("machines")
        )

    @cached_property
    def catalog(self) -> DataFrame:
        return registry.catalog(self.stg, self.master)

    @cached_property
    def text_messages(self) -> DataFrame:
        """Events as JSON text, some broken: no JSON at all, no device, a reading that is no number."""
        k = F.col("k")
        power = F.when(F.col("event_type") == "error", F.lit('"bad"')).otherwise(F.col("reading").cast("string"))
        device = F.when(k == 50, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("deviceId"), F.lit('"')))
        body = F.concat(
            F.lit('{"deviceId":'), device,
            F.lit(',"source":"'), F.col("source"),
            F.lit('","equipmentType":"'), F.col("equipmentType"),
            F.lit('","building":"'), F.col("building"),
            F.lit('","ts_utc":'), F.col("ts_utc").cast("string"),
            F.lit(',"value":{"totalPower":'), power, F.lit(',"level":'), k.cast("string"),
            F.lit('},"metadata":{"msgId":"'), F.col("event_id").cast("string"),
            F.lit('","deviceId":"'), F.col("deviceId"), F.lit('"}}'),
        )
        events = self.events.withColumn("reading", F.col("event_id") / F.lit(2.0))
        return events.select(
            F.when(k == 7, F.lit("not json")).otherwise(body).alias("value"), F.lit("bms.telemetry.test").alias("topic"), F.col("event_id").alias("offset")
        )
