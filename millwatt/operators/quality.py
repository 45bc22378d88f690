"""Declarative column checks.

Every check yields ``(model, column, test, failures)``. Checks of one kind on one model share one
scan, and values are counted map-side first, so one that fills a third of a table costs one row per
task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions.clock import newest_time


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple = ()
    to_model: str = ""
    to_column: str = ""


def _checks(test: str, *columns: str) -> list[Check]:
    return [Check(*column.split("."), test) for column in columns]


_DIM_KEYS = (
    "dim_date.date_id",
    "dim_time.time_key",
    "dim_location.building",
    "dim_equipment.equipment_key",
    "dim_equipment.name",
    "dim_machine.machine_key",
    "dim_machine.machine_id",
    "dim_product.product_key",
    "dim_work_order.work_order_key",
    "dim_work_order.work_order_id",
    "dim_shift.shift_key",
)

# The checks declared on the marts and on the raw source.
NOT_NULL = _checks(
    "not_null",
    *_DIM_KEYS,
    "dim_location.building_code",
    "fact_hvac_reading.equipment_key",
    "fact_energy_reading.machine_key",
    "fact_energy_reading.total_power",
    "fact_energy_reading.total_energy",
)
SOURCE_NOT_NULL = _checks(
    "not_null", "telemetry.time", "telemetry.value", "telemetry.dimensions", "telemetry.device_id"
)
UNIQUE = _checks("unique", *_DIM_KEYS)
RELATIONSHIPS = [
    Check(child, column, "relationships", to_model=parent, to_column=column)
    for child, column, parent in (
        ("fact_hvac_reading", "equipment_key", "dim_equipment"),
        ("fact_hvac_reading", "date_id", "dim_date"),
        ("fact_hvac_reading", "time_key", "dim_time"),
        ("fact_energy_reading", "machine_key", "dim_machine"),
        ("fact_energy_reading", "date_id", "dim_date"),
        ("fact_energy_reading", "time_key", "dim_time"),
        ("fact_production", "work_order_key", "dim_work_order"),
        ("fact_production", "machine_key", "dim_machine"),
        ("fact_machine_state", "machine_key", "dim_machine"),
    )
]
ACCEPTED_VALUES = [
    Check(
        "dim_date",
        "day_name",
        "accepted_values",
        ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    ),
    Check("dim_equipment", "equipment_type", "accepted_values", C.EQUIPMENT_TYPES),
    Check("dim_equipment", "is_active", "accepted_values", (True, False)),
    Check("dim_machine", "machine_type", "accepted_values", tuple(C.MACHINE_TYPE_ORDER)),
]
ALL_CHECKS = [*NOT_NULL, *SOURCE_NOT_NULL, *UNIQUE, *RELATIONSHIPS, *ACCEPTED_VALUES]


def _not_null(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All not-null checks of a model from one scan: ``n, failures`` by check number."""
    counted = df.agg(
        *[F.count_if(F.col(check.column).isNull()).alias(f"n{i}") for i, check in enumerate(checks)]
    )
    rows = [F.struct(F.lit(i).alias("n"), F.col(f"n{i}").alias("failures")) for i in range(len(checks))]
    return counted.select(F.inline(F.array(*rows)))


def _value_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """How often each value of the checked columns occurs, from one scan: ``n, value, rows``."""
    pairs = [
        F.struct(F.lit(i).alias("n"), F.col(check.column).cast("string").alias("value"))
        for i, check in enumerate(checks)
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("n", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _unique(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    repeated = _value_counts(df, checks).where("rows > 1")
    return repeated.groupBy("n").agg(F.count(F.lit(1)).alias("failures"))


def _relationships(child: DataFrame, checks: Sequence[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose key has no parent: distinct keys with their counts meet all parents at once."""
    parents = [
        models[check.to_model].select(
            F.lit(i).alias("n"), F.col(check.to_column).cast("string").alias("value")
        )
        for i, check in enumerate(checks)
    ]
    known = reduce(DataFrame.unionByName, parents)
    orphans = _value_counts(child, checks).join(known, ["n", "value"], "left_anti")
    return orphans.groupBy("n").agg(F.sum("rows").alias("failures"))


def _accepted(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    def text(value) -> str:
        return str(value).lower() if isinstance(value, bool) else str(value)

    strange = F.lit(False)
    for i, check in enumerate(checks):
        known = F.col("value").isin(*[text(value) for value in check.values])
        strange = strange | ((F.col("n") == i) & ~known)
    return _value_counts(df, checks).where(strange).groupBy("n").agg(
        F.count(F.lit(1)).alias("failures")
    )


def run(models: Mapping[str, DataFrame], checks: Sequence[Check] = ALL_CHECKS) -> DataFrame:
    """Results of ``checks``, one row each; checks of one kind on one model share a scan."""
    groups: dict[tuple[str, str], list[Check]] = {}
    for check in checks:
        groups.setdefault((check.model, check.test), []).append(check)
    return reduce(
        DataFrame.unionByName,
        [_group(models, model, test, group) for (model, test), group in groups.items()],
    )


def _group(models: Mapping[str, DataFrame], model: str, test: str, checks: list[Check]) -> DataFrame:
    df = models[model]
    if test == "not_null":
        found = _not_null(df, checks)
    elif test == "unique":
        found = _unique(df, checks)
    elif test == "relationships":
        found = _relationships(df, checks, models)
    elif test == "accepted_values":
        found = _accepted(df, checks)
    else:
        raise ValueError(f"unknown test: {test}")
    # One row per check of the group, also for those that found nothing.
    counts = found.agg(F.map_from_entries(F.collect_list(F.struct("n", "failures"))).alias("found"))
    rows = [
        F.struct(
            F.lit(check.model).alias("model"),
            F.lit(check.column).alias("column"),
            F.lit(check.test).alias("test"),
            F.coalesce(F.col("found")[i], F.lit(0)).cast("bigint").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def contract(
    raw: DataFrame, rules: DataFrame, stale_after_minutes: int = 60, as_of: Column | None = None
) -> DataFrame:
    """Ingestion contract per equipment type and metric.

    ``rules`` holds ``equipment_type, metric, lo, hi``: one row per profile metric, so it is
    broadcast. Counts readings of the type that lack the metric and readings out of range, and
    tells whether the type's newest reading is older than ``stale_after_minutes``.
    """
    if as_of is None:
        as_of = newest_time(raw)
    readings = raw.select("time", F.col("dimensions")["equipmentType"].alias("equipment_type"), "value")
    ruled = readings.join(F.broadcast(rules), "equipment_type")
    reading = F.col("value")[F.col("metric")]
    return (
        ruled.groupBy("equipment_type", "metric")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.count_if(reading.isNull()).alias("missing"),
            F.count_if(~reading.between(F.col("lo"), F.col("hi"))).alias("out_of_range"),
            F.max("time").alias("newest"),
        )
        .withColumn("stale", F.col("newest") < as_of - F.expr(f"INTERVAL {int(stale_after_minutes)} MINUTES"))
        .drop("newest")
    )
