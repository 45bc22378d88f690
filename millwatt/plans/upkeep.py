"""Jobs that keep the stored tables in shape; a scheduler runs them between builds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.operators import landing
from millwatt.plans import pipeline
from millwatt.sources import telemetry
from millwatt.sources.changelog import ChangeTable
from millwatt.sources.rawtable import RawTable


def change_tables(tables: Iterable[ChangeTable]) -> list[int]:
    """Write the next base of each table and remove what it covers; returns the bases' versions."""
    versions = []
    for table in tables:
        versions.append(table.compact())
        table.clean()
    return versions


def retire(spark: SparkSession, path: str, days: int = C.RETAIN_DAYS, as_of: Column | None = None) -> list[str]:
    """Delete the days of a raw table that the retention rule gives up; returns them."""
    oldest = pipeline.expire(telemetry.read_raw(spark, path), days, as_of).agg(F.max("date")).first()[0]
    if oldest is None:
        return []
    following = spark.range(1).select(F.date_add(F.lit(oldest), 1).cast("string")).first()[0]
    return telemetry.drop_days(spark, path, following)


def compact(spark: SparkSession, path: str, target: str, days: int = C.COMPACT_AFTER_DAYS, files: int = 64) -> DataFrame:
    """Write a raw table anew at ``target`` with its settled days sorted into few files, and read it from there."""
    raw = telemetry.read_raw(spark, path)
    before = spark.range(1).select(landing.newest_day(raw, days).cast("string")).first()[0]
    telemetry.compact_days(spark, path, target, before, files)
    return telemetry.read_raw(spark, target)


def settle(spark: SparkSession, path: str, days: int = C.COMPACT_AFTER_DAYS) -> list[str]:
    """Compact the settled days of a raw table in place, while streams land into it; returns the days written."""
    table = RawTable(spark, path)
    before = spark.range(1).select(landing.newest_day(table.read(), days).cast("string")).first()[0]
    return table.compact(before) if before else []
