"""Running energy per device as keyed state of the stream itself, with a notice when a device falls silent.

Spark keeps one value a device in its state store (RocksDB, so it may exceed memory) and gives each micro-batch's
readings of a device to :class:`EnergyCounter`. The state lives in the checkpoint and goes on after a restart. An event-time
timer a device runs out ``idle`` after its last reading and is set anew by the next one.

A micro-batch's readings of one device are sorted in one task, so their number has to be bounded by the source
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). Where one device holds a large share of all readings,
:mod:`millwatt.streaming.energy` cuts it into chunks instead, at the price of a state table written per batch.

Output rows have a ``kind``: ``total`` for a reading with its total, ``late`` for one that does not come after the last one
counted, ``idle`` for a device that fell silent, with its last reading's time and total. Spark drops rows that are
behind the watermark before they get here and counts them in the query's progress.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from millwatt.functions.numeric import NUMERIC
from millwatt.operators import signals

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "micros long, msg string, work string"
OUTPUT = "kind string, device_id string, micros long, msg_id string, power string, work string"


class EnergyCounter(StatefulProcessor):
    """Adds up power over time for one device; work is a whole number of millionths of a kilowatt-microsecond."""

    def __init__(self, idle_millis: int):
        self.idle_millis = idle_millis

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        readings = pd.concat(list(rows), ignore_index=True)
        order = pd.Series(readings["msg_id"].fillna(""))
        readings = readings.assign(_msg=order).sort_values(["micros", "_msg"], kind="stable")
        micros, msgs = readings["micros"].to_numpy(np.int64), readings["_msg"].to_numpy()
        work, last = 0, None
        if self.last.exists():
            stored = self.last.get()
            last, work = (int(stored[0]), stored[1]), int(stored[2])
        fresh = np.ones(len(readings), bool)
        if last is not None:
            fresh = (micros > last[0]) | ((micros == last[0]) & (msgs > last[1]))
        if (~fresh).any():
            late = readings[~fresh]
            yield self._rows("late", key[0], late["micros"], late["msg_id"], late["power"], [None] * len(late))
        if not fresh.any():
            return
        kept, at = readings[fresh], micros[fresh]
        before = np.concatenate([[at[0] if last is None else last[0]], at[:-1]])
        # Whole numbers of any size: totals are exact and do not depend on the batches.
        units = [0 if pd.isna(u) else int(u) for u in kept["units"]]
        totals = []
        for unit, span in zip(units, (at - before).tolist(), strict=True):
            work += unit * span
            totals.append(str(work))
        yield self._rows("total", key[0], kept["micros"], kept["msg_id"], kept["power"], totals)
        self.last.update((int(at[-1]), str(msgs[fresh][-1]), str(work)))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(at[-1]) // 1000 + self.idle_millis)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        micros, msg, work = self.last.get()
        yield self._rows("idle", key[0], [int(micros)], [msg or None], [None], [work])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(kind, device, micros, msg_id, power, work) -> pd.DataFrame:
        n = len(work)
        columns = {"kind": [kind] * n, "device_id": [device] * n, "micros": list(micros), "msg_id": list(msg_id), "power": list(power), "work": list(work)}
        return pd.DataFrame(columns)


def count(readings: DataFrame, idle: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Totals, late readings and idle notices of a stream of ``device_id, time, msg_id, total_power``.

    A device is silent ``idle`` after its last reading once the watermark, ``delay`` behind the newest reading of
    all, has passed that point. Power counts to six decimals, as in :func:`millwatt.operators.signals.accumulate_work`.
    """
    units = (F.col("total_power").try_cast("decimal(18,6)") * F.lit(Decimal(1_000_000))).cast("bigint")
    prepared = readings.where(F.col("device_id").isNotNull() & F.col("time").isNotNull()).select(
        "device_id",
        F.col("time"),
        "msg_id",
        F.unix_micros("time").alias("micros"),
        units.alias("units"),
        F.col("total_power").cast("string").alias("power"),
    )
    idle_millis = int(pd.Timedelta(idle).total_seconds() * 1000)
    counted = (
        prepared.withWatermark("time", delay)
        .groupBy("device_id")
        .transformWithStateInPandas(EnergyCounter(idle_millis), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
    )
    work = (F.col("work").cast("decimal(38,0)") / F.lit(Decimal(1_000_000))).cast(signals.WORK)
    return counted.select(
        "kind",
        "device_id",
        F.timestamp_micros("micros").alias("time"),
        "msg_id",
        F.col("power").cast(NUMERIC).alias("total_power"),
        work.alias("total_work"),
        signals.kilowatt_hours(work).alias("total_kwh"),
    )


def start(
    readings: DataFrame, out: str, checkpoint: str, idle: str = "1 hour", delay: str = "1 day", trigger: dict | None = None
) -> StreamingQuery:
    """Write :func:`count` to ``out``, by kind."""
    spark = readings.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)  # a query keeps the settings it was started with
    try:
        return (
            count(readings, idle, delay)
            .writeStream.format("parquet")
            .partitionBy("kind")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"processingTime": "2 seconds"}))
            .start()
        )
    finally:
        spark.conf.set(name, before)
