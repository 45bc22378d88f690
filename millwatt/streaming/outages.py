"""Freshness as a stream: a row once a device has been silent for a while.

Readings of a device that follow each other within ``gap`` are one session. Spark keeps the open sessions in its state
store and gives a session out when the watermark has passed its end, that is, when nothing more can come within ``gap`` of its last
reading: the device fell silent then. The same grouping on a table gives the sessions of the past.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(readings: DataFrame, gap: str, keys: Sequence[str] = ("device_id", "equipment_type"), delay: str = "30 seconds") -> DataFrame:
    """``keys, first_time, last_time, silent_from, readings`` of each session; ``silent_from`` is ``gap`` after the last reading.

    Counts are merged in each task before they are shuffled, so a busy device is one row a task and session.
    """
    timed = readings.withWatermark("time", delay) if readings.isStreaming else readings
    grouped = timed.groupBy(*keys, F.session_window("time", gap).alias("session"))
    counted = grouped.agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count(F.lit(1)).alias("readings"))
    return counted.select(*keys, "first_time", "last_time", F.col("session.end").alias("silent_from"), "readings")


def start(
    readings: DataFrame, out: str, checkpoint: str, gap: str, delay: str = "30 seconds", trigger: dict | None = None
) -> StreamingQuery:
    """Write a row to ``out`` for every device that falls silent for ``gap``."""
    return (
        sessions(readings, gap, delay=delay)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


def by_type(silences: DataFrame, until: str | None = None) -> DataFrame:
    """Per equipment type: silences, devices concerned, longest session before one; of those that began before ``until``."""
    if until:
        silences = silences.where(F.col("silent_from") < F.lit(until).cast("timestamp"))
    length = F.unix_micros("last_time") - F.unix_micros("first_time")
    return silences.groupBy("equipment_type").agg(
        F.count(F.lit(1)).alias("silences"), F.countDistinct("device_id").alias("devices"), (F.max(length) / 60e6).alias("longest_minutes")
    )
