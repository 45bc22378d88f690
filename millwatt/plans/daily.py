"""An incremental build of the telemetry marts: only days into which readings came are built again.

What depends on a day alone (typed rows, climate facts, machine readings with differences inside the day) is stored by day. What crosses
days goes through two narrow tables with one row for each device and day: ``seams`` holds the day's first and last reading and the energy
integrated inside it; ``links`` holds the device's last reading before the day and its total up to the day's first one. A late
reading therefore costs its own day, and the links of the days from then on, which are worked out from the seams: the
readings of other days are not read. Minutes are rolled up with their day, and hours are merged from them.

A manifest names the folder of every table's days and, for each day, how much had landed when it was built; it is written last, so
readers see a build at once or not at all. When the machines, equipment or calendar changed, all days are built again. Copies
of a message are removed within their day, as they carry the same time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millwatt.functions.numeric import NUMERIC
from millwatt.operators import dims, facts, landing, ordered, rollups, signals, staging
from millwatt.sources.files import delete_folder, folders
from millwatt.sources.parts import Manifest
from millwatt.sources.rawtable import RawTable
from millwatt.sources.telemetry import by_device

DAY = "date"
BY_DAY = ("telemetry", "fact_hvac_reading", "machine_readings", "minutes", "seams", "links")
_READING = ("time", "msg_id", "total_energy", "total_power")


def inside_days(readings: DataFrame, **chunking) -> DataFrame:
    """Machine readings with the difference to the one before and the running work, both within the device's day.

    ``is_first`` marks the first reading of a device and day, whose difference and work depend on days before.
    """
    keys, order = ["device_id", DAY], ["time", "msg_id"]
    cut = ordered.chunked(readings.withColumn(DAY, F.to_date("time")), keys, order, **chunking)
    seen = ordered.previous(cut, keys, order, {"_before": F.struct("time", F.col("total_energy").alias("energy"))})
    first = F.col("_before").isNull()
    added = F.when(first, F.lit(0)).otherwise(work_between(F.col("total_power"), F.col("_before.time"), F.col("time")))
    stepped = seen.select(
        *readings.columns,
        DAY,
        ordered.CHUNK,
        first.alias("is_first"),
        F.when(~first, (F.col("total_energy") - F.col("_before.energy")).cast(NUMERIC)).alias("delta_kwh"),
        added.cast(signals.WORK).alias("_added"),
    )
    return ordered.running_sum(stepped, keys, order, {"day_work": F.col("_added")}).drop(ordered.CHUNK, "_added")


def work_between(power: Column, start: Column, end: Column) -> Column:
    """Kilowatt-microseconds of a power between two times, 0 without a power; as :func:`signals.accumulate_work` counts."""
    span = (F.unix_micros(end) - F.unix_micros(start)).cast("decimal(19,0)")
    return F.coalesce(power.try_cast("decimal(18,6)") * span, F.lit(0)).cast(signals.WORK)


def seams(readings: DataFrame) -> DataFrame:
    """First and last reading and the work inside the day, for each device and day of :func:`inside_days`."""
    reading, order = F.struct(*_READING), F.struct("time", "msg_id")
    return readings.groupBy("device_id", DAY).agg(
        F.min_by(reading, order).alias("first"), F.max_by(reading, order).alias("last"), F.max_by("day_work", order).alias("work")
    )


def links(seam_rows: DataFrame, **chunking) -> DataFrame:
    """For each device and day the last reading before it, and the total work up to its first reading."""
    seen = ordered.previous(seam_rows, ["device_id"], [DAY], {"before": F.col("last")}, **chunking)
    gap = F.when(F.col("before").isNull(), F.lit(0)).otherwise(
        work_between(F.col("first.total_power"), F.col("before.time"), F.col("first.time"))
    )
    # The total before the day's own work is the running total less that.
    summed = ordered.running_sum(
        seen.withColumn("_gap", gap.cast(signals.WORK)), ["device_id"], [DAY], {"_total": F.col("_gap") + F.col("work")}
    )
    return summed.select("device_id", DAY, "before", (F.col("_total") - F.col("work")).cast(signals.WORK).alias("total_before"))


def reset_safe(delta: Column, energy: Column) -> Column:
    """Energy used since the reading before; after a reset of the counter it is the counter itself."""
    return F.when(delta < 0, energy).otherwise(delta)


class DailyBuild:
    """Marts under ``folder``, kept up to date from a raw table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifest = Manifest(spark, f"{self.folder}/manifest")

    def changed_days(self, raw: RawTable, dimensions: str = "") -> tuple[list[str], list[str]]:
        """Days to build, and days that the raw table no longer has."""
        return self._changed(self.manifest.entries(), raw.day_totals(), dimensions)

    @staticmethod
    def _changed(entries: dict[str, dict[str, str]], totals: dict[str, int], dimensions: str) -> tuple[list[str], list[str]]:
        built = entries.get("built", {})
        same = entries.get("dimensions", {}).get("digest", "") == dimensions
        changed = sorted(day for day, n in totals.items() if not same or built.get(day) != str(n))
        return changed, sorted(set(built) - set(totals))

    def run(self, raw: RawTable, master: DataFrame, machines: DataFrame, calendar: DataFrame | None = None, **chunking) -> list[str]:
        """Build what changed and publish it; returns the days that were built."""
        spark = self.spark
        dim_date = dims.calendar(spark) if calendar is None else calendar
        tables = {
            "dim_date": dim_date,
            "dim_time": dims.minutes(spark),
            "dim_equipment": dims.equipment(master),
            "dim_machine": dims.machine(staging.machines(machines)),
        }
        digest = self._digest(tables)
        entries, totals = self.manifest.entries(), raw.day_totals()
        changed, gone = self._changed(entries, totals, digest)
        if not changed and not gone:
            return []
        number = self.manifest.version() + 1
        fresh = entries.get("dimensions", {}).get("digest") != digest
        for name, df in tables.items() if fresh else ():
            path = f"{self.folder}/{name}/build={number}"
            df.write.mode("overwrite").parquet(path)
            entries.setdefault("table", {})[name] = path
            entries.setdefault("schema", {})[name] = df.schema.json()
        model = {name: self.read(name, None, entries) for name in tables}

        silver = landing.dedupe(staging.telemetry(raw.read(changed)), F.col("msg_id")).withColumn(DAY, F.to_date("time"))
        self._write(entries, number, "telemetry", by_device(silver), changed, gone)
        stg = self.read("telemetry", changed, entries)
        days, clock = model["dim_date"], model["dim_time"]
        hvac = facts.hvac(staging.ahu(stg), staging.chiller(stg), model["dim_equipment"], days, clock)
        self._write(entries, number, "fact_hvac_reading", hvac.withColumn(DAY, F.to_date("time")), changed, gone)
        readings = facts.machine_readings(staging.machine_readings(stg), model["dim_machine"], days, clock)
        self._write(entries, number, "machine_readings", inside_days(readings, **chunking), changed, gone)
        inside = self.read("machine_readings", changed, entries)
        used = inside.withColumn("delta_kwh_reset_safe", reset_safe(F.col("delta_kwh"), F.col("total_energy")))
        minutes = rollups.by_minute(used).withColumn(DAY, F.to_date("bucket"))
        self._write(entries, number, "minutes", minutes, changed, gone)
        self._write(entries, number, "seams", seams(inside), changed, gone)
        # A changed day may move the link of any later one; links are a row for each device and day.
        since = min([*changed, *gone])
        linked = links(self.read("seams", None, entries), **chunking).where(F.col(DAY) >= F.lit(since).cast("date"))
        later = [day for day in {*entries["day:seams"], *totals} if day >= since]
        self._write(entries, number, "links", linked, later, gone)
        built = {} if fresh else entries.get("built", {})
        entries["built"] = {day: n for day, n in built.items() if day in totals} | {day: str(totals[day]) for day in changed}
        entries["dimensions"] = {"digest": digest}
        self.manifest.publish(entries)
        return changed

    def _digest(self, tables: dict[str, DataFrame]) -> str:
        """One number for the content of the dimensions."""
        rows = [df.select(F.xxhash64(F.lit(name), *df.columns).alias("h")) for name, df in sorted(tables.items())]
        found = reduce(DataFrame.unionByName, rows).agg(F.count("*").alias("n"), F.bit_xor("h").alias("h"), F.sum(F.col("h") % 1_000_003).alias("s")).first()
        return f"{found.n}:{found.h}:{found.s}"

    def _write(self, entries: dict, number: int, name: str, df: DataFrame, days: Iterable[str], gone: Iterable[str]) -> None:
        """Write some days of a table; the other days keep their folders."""
        root = f"{self.folder}/{name}/build={number}"
        spread = df if name == "telemetry" else df.hint("rebalance", DAY)
        spread.write.mode("overwrite").partitionBy(DAY).option("compression", "zstd").parquet(root)
        made = {p.rstrip("/").rsplit("=", 1)[1]: p for p in folders(self.spark, f"{root}/{DAY}=*")}
        replaced = {*days, *gone}
        entries[f"day:{name}"] = {d: p for d, p in entries.get(f"day:{name}", {}).items() if d not in replaced} | made
        entries.setdefault("schema", {})[name] = df.schema.json()

    def read(self, name: str, days: Iterable[str] | None = None, entries: dict | None = None) -> DataFrame:
        """A table of the newest build, or some days of it; a filter on ``date`` prunes, too."""
        entries = self.manifest.entries() if entries is None else entries
        schema = StructType.fromJson(json.loads(entries["schema"][name]))
        if name not in BY_DAY:
            return self.spark.read.schema(schema).parquet(entries["table"][name])
        wanted = None if days is None else set(days)
        paths = [p for day, p in sorted(entries[f"day:{name}"].items()) if wanted is None or day in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        placed = self.spark.read.schema(StructType([*schema.fields, StructField("build", LongType())])).option("basePath", f"{self.folder}/{name}")
        return placed.parquet(*paths).drop("build")

    def energy(self, days: Iterable[str] | None = None) -> DataFrame:
        """``fact_energy_reading``, of all days or some; only first readings of a day meet their links."""
        entries = self.manifest.entries()
        rows, linked = self.read("machine_readings", days, entries), self.read("links", days, entries)
        before = linked.select("device_id", DAY, F.col("before.total_energy").alias("_before"))
        delta = (F.col("total_energy") - F.col("_before")).cast(NUMERIC)
        first = rows.where("is_first").join(before, ["device_id", DAY]).withColumn("delta_kwh", delta)
        every = rows.where("not is_first").unionByName(first.select(*rows.columns))
        safe = reset_safe(F.col("delta_kwh"), F.col("total_energy"))
        return every.withColumn("delta_kwh_reset_safe", safe).drop("is_first", "day_work")

    def hours(self, days: Iterable[str] | None = None) -> DataFrame:
        """Hourly roll-up from the stored minutes; the energy across two days comes from the links."""
        entries = self.manifest.entries()
        linked = self.read("seams", days, entries).join(self.read("links", days, entries), ["device_id", DAY])
        energy = F.col("first.total_energy")
        delta = (energy - F.col("before.total_energy")).cast(NUMERIC)
        across = linked.select(
            "device_id", F.date_trunc("minute", "first.time").alias("bucket"), F.lit(0).cast("bigint").alias("readings"), reset_safe(delta, energy).alias("kwh")
        )
        minutes = self.read("minutes", days, entries).drop(DAY, "power_avg")
        return rollups.by_hour(minutes.unionByName(across, allowMissingColumns=True))

    def totals(self, days: Iterable[str] | None = None) -> DataFrame:
        """Readings with the device's running energy, ``total_work`` and ``total_kwh``, from the first day on."""
        entries = self.manifest.entries()
        rows, linked = self.read("machine_readings", days, entries), self.read("links", days, entries)
        total = (F.col("total_before") + F.col("day_work")).cast(signals.WORK)
        joined = rows.join(linked.select("device_id", DAY, "total_before"), ["device_id", DAY])
        return joined.select(
            "device_id", "time", "msg_id", "total_power", total.alias("total_work"), signals.kilowatt_hours(total).alias("total_kwh")
        )

    def clean(self) -> list[str]:
        """Remove folders that the newest build does not use; run it when no reader is on older ones."""
        # Compared below the marts' folder, as listings spell the file system out.
        below = lambda path: path[path.rstrip("/").index(f"/{root}/") :].rstrip("/")
        root = self.folder.rsplit("/", 1)[1]
        used = {below(p) for kind, values in self.manifest.entries().items() if kind == "table" or kind.startswith("day:") for p in values.values()}
        stored = folders(self.spark, f"{self.folder}/*/build=*/{DAY}=*") + folders(self.spark, f"{self.folder}/dim_*/build=*")
        gone = [p for p in stored if below(p) not in used]
        for path in gone:
            delete_folder(self.spark, path)
        self.manifest.clean()
        return sorted(gone)
