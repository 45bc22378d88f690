"""Checks on the course of a reading: integration, spikes, lateness, stuck and off-setpoint values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions.labels import lookup
from millwatt.functions.numeric import NUMERIC, ratio
from millwatt.operators import ordered


# Power times time is kept as an exact number of kilowatt-microseconds and divided once at the end.
WORK = "decimal(38,6)"
MICROS_PER_HOUR = 3_600_000_000


def kilowatt_hours(work: Column) -> Column:
    """Kilowatt-microseconds as kWh, rounded half up to five places."""
    return F.round(work.cast("decimal(28,6)") / F.lit(MICROS_PER_HOUR), 5)


def accumulate_work(
    readings: DataFrame,
    power: str = "total_power",
    time: str = "time",
    ties: Iterable[str] = ("msg_id",),
    key: str = "device_id",
    **chunking,
) -> DataFrame:
    """Add ``added_work`` and its running sum ``total_work`` per device.

    A reading's power counts for the time since the reading before; the first reading and one
    without power, or with one beyond a million million kW, add nothing. Power counts to six decimals.
    """
    order = [time, *ties]
    seen = ordered.previous(readings, [key], order, {"_before": F.col(time)}, **chunking)
    span = (F.unix_micros(time) - F.unix_micros("_before")).cast("decimal(19,0)")
    added = F.coalesce(F.col(power).try_cast("decimal(18,6)") * span, F.lit(0)).cast(WORK)
    stepped = seen.withColumn("added_work", added).drop("_before")
    return ordered.running_sum(stepped, [key], order, {"total_work": F.col("added_work")}).drop(
        ordered.CHUNK
    )


def integrate_energy(readings: DataFrame, **options) -> DataFrame:
    """Running kWh per device from power readings, see :func:`accumulate_work`."""
    return accumulate_work(readings, **options).select(
        *readings.columns,
        kilowatt_hours(F.col("added_work")).alias("added_kwh"),
        kilowatt_hours(F.col("total_work")).alias("total_kwh"),
    )


def spikes(
    readings: DataFrame,
    value: str = "total_power",
    rows: int = 10,
    threshold: float = 3.0,
    key: str = "device_id",
    order: Iterable[str] = ("time", "msg_id"),
    **chunking,
) -> DataFrame:
    """Readings more than ``threshold`` standard deviations from the mean of the ``rows`` before.

    The deviation is taken from the distances to the mean, so large readings with little spread keep
    their digits; fewer than ``rows`` readings before, or no spread among them, give no score.
    """
    known = readings.where(F.col(value).isNotNull())
    windowed = ordered.trailing(
        known,
        [key],
        list(order),
        rows,
        {"_n": F.count(F.col(value)), "_sum": F.sum(F.col(value)), "_seen": F.collect_list(F.col(value).cast("double"))},
        **chunking,
    )
    average = windowed.where(F.col("_n") == rows).withColumn("baseline", ratio(F.col("_sum"), F.col("_n")))
    squares = F.aggregate(
        F.transform("_seen", lambda x: (x - F.col("baseline")) * (x - F.col("baseline"))), F.lit(0.0), lambda a, x: a + x
    )
    deviation = F.sqrt(squares / F.col("_n"))
    scored = average.withColumn("_deviation", deviation).where(F.col("_deviation") > F.abs("baseline") * F.lit(1e-12))
    return scored.select(
        *readings.columns,
        "baseline",
        ((F.col(value).cast("double") - F.col("baseline")) / F.col("_deviation")).alias("z_score"),
    ).where(F.abs("z_score") > threshold)


def late_rows(
    arrivals: DataFrame,
    arrival: str,
    time: str = "time",
    lateness_seconds: int = C.LATENESS_SECONDS,
    **chunking,
) -> DataFrame:
    """Rows whose time is more than ``lateness_seconds`` behind the newest one that arrived before.

    ``arrival`` is a unique serial number, dense or not; runs of it are handled apart and only their
    newest times are compared across the table.
    """
    seen = ordered.running_max(arrivals, [], [arrival], {"newest": F.col(time)}, **chunking)
    limit = F.col("newest") - F.expr(f"INTERVAL {int(lateness_seconds)} SECONDS")
    return seen.where(F.col(time) < limit).drop(ordered.CHUNK)


# States a machine may move to from each state.
ALLOWED_STEPS = {"RUN": ("RUN", "IDLE", "DOWN"), "IDLE": ("IDLE", "RUN"), "DOWN": ("DOWN", "IDLE")}


def state_steps(states: DataFrame, tie: str = "id", allowed: dict = ALLOWED_STEPS, **chunking) -> DataFrame:
    """Every state with the one before and whether the step is allowed (the first one is)."""
    seen = ordered.previous(
        states, ["machine_id"], ["start_time", tie], {"previous_state": F.col("state")}, **chunking
    ).drop(ordered.CHUNK)
    legal: Column = F.col("previous_state").isNull()
    for before, after in allowed.items():
        legal = legal | ((F.col("previous_state") == before) & F.col("state").isin(*after))
    return seen.withColumn("allowed", legal)


def long_metrics(raw: DataFrame) -> DataFrame:
    """One row per reading and metric."""
    return raw.select(
        "time",
        "device_id",
        F.col("dimensions")["equipmentType"].alias("equipment_type"),
        F.col("metadata")["msgId"].alias("msg_id"),
        F.explode("value").alias("metric", "reading"),
    )


def profile_metrics(spark: SparkSession) -> DataFrame:
    """The HVAC profiles, one row per type and metric."""
    names = ("equipment_type", "metric", "unit", "setpoint")
    rows = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)])
        for row in C.PROFILE_METRICS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def setpoint_deviation(raw: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per device and metric: mean and greatest distance from the setpoint.

    ``profiles`` is the fixed profile table of a few dozen rows, so it is broadcast.
    """
    joined = long_metrics(raw).join(F.broadcast(profiles), ["equipment_type", "metric"])
    gap = (F.col("reading") - F.col("setpoint")).try_cast(NUMERIC)
    return joined.groupBy("device_id", "equipment_type", "metric", "unit").agg(
        F.count(gap).alias("readings"),
        ratio(F.sum(gap), F.count(gap)).alias("mean_deviation"),
        F.max(F.abs(gap)).alias("max_deviation"),
    )


def low_delta(raw_delta: DataFrame, share: float = 0.5) -> DataFrame:
    """Readings whose supply-to-return gap is under ``share`` of the type's nominal gap."""
    nominal = lookup(F.col("equipment_type"), C.NOMINAL_DELTA)
    return raw_delta.withColumn("nominal_delta", nominal).where(
        F.col("delta_temp_nullable") < F.col("nominal_delta") * share
    )


def stuck_values(
    readings: DataFrame,
    keys: list[str],
    value: str,
    order: list[str],
    min_rows: int = 3,
    **chunking,
) -> DataFrame:
    """Runs of at least ``min_rows`` equal readings in a row, with first and last time."""
    seen = ordered.previous(readings, keys, order, {"_before": F.col(value)}, **chunking)
    begins = F.when(F.col(value).eqNullSafe(F.col("_before")), 0).otherwise(1).cast("bigint")
    marked = seen.withColumn("_begins", begins)
    numbered = ordered.running_sum(marked, keys, order, {"_run": F.col("_begins")})
    time = order[0]
    runs = numbered.groupBy(*keys, "_run").agg(
        F.first(value).alias("stuck_at"),
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )
    return runs.where((F.col("rows") >= min_rows) & F.col("stuck_at").isNotNull()).drop("_run")
