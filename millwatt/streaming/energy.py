"""Running energy per device over micro-batches.

Each batch is integrated with the batch operator, which cuts a busy device's rows into chunks, and
starts from one stored row per device (last reading's time and message, total so far). The stored
rows are a table of versions, each named by the stream and batch that wrote it: a batch that is run
again starts from the version before its own and writes the same result, and a stream with a new
checkpoint goes on from the newest version. Readings that do not come after the stored one, by
time and message id, cannot be placed any more and are set aside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatt.functions.numeric import NUMERIC
from millwatt.operators import signals
from millwatt.streaming.runs import before, forget, stream_id

STATE = f"device_id string, last_time timestamp, last_msg string, total_work {signals.WORK}"


def start(readings: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """``readings`` holds ``device_id, time, msg_id, total_power``; totals go to ``out/totals``."""
    return (
        readings.writeStream.foreachBatch(_writer(out, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


def advance(readings: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings with their running total, and readings that came too late to count."""
    joined = readings.join(state, "device_id", "left")
    # A reading without a message id comes first among those of its time.
    after = (F.col("time") > F.col("last_time")) | (
        (F.col("time") == F.col("last_time")) & (F.coalesce("msg_id", F.lit("")) > F.coalesce("last_msg", F.lit("")))
    )
    late = joined.where(F.col("last_time").isNotNull() & ~F.coalesce(after, F.lit(False))).select(*readings.columns)
    fresh = joined.where(F.col("last_time").isNull() | after).select(*readings.columns)
    # The stored reading stands before the batch; its own power is already counted.
    seeds = state.select(
        "device_id",
        F.col("last_time").alias("time"),
        F.col("last_msg").alias("msg_id"),
        F.lit(None).cast(NUMERIC).alias("total_power"),
    )
    fresh = fresh.select(
        "device_id", "time", "msg_id", F.col("total_power").cast(NUMERIC).alias("total_power"), F.lit(False).alias("_seed")
    )
    stacked = fresh.unionByName(seeds.withColumn("_seed", F.lit(True)))
    added = signals.accumulate_work(stacked).where(~F.col("_seed")).drop("_seed")
    before = state.select("device_id", F.col("total_work").alias("_stored"))
    total = (F.col("total_work") + F.coalesce("_stored", F.lit(0))).cast(signals.WORK)
    totals = added.join(before, "device_id", "left").select(
        "device_id",
        "time",
        "msg_id",
        "total_power",
        total.alias("total_work"),
        signals.kilowatt_hours(total).alias("total_kwh"),
    )
    return totals, late


def next_state(state: DataFrame, totals: DataFrame) -> DataFrame:
    """Stored rows after the batch: the last total of devices seen, the old row of the others."""
    last = F.max_by("total_work", F.struct("time", "msg_id"))
    seen = totals.groupBy("device_id").agg(
        F.max("time").alias("last_time"),
        F.max(F.struct("time", "msg_id"))["msg_id"].alias("last_msg"),
        last.alias("total_work"),
    )
    return seen.unionByName(state.join(seen.select("device_id"), "device_id", "left_anti"))


def _writer(out: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        version, state = before(spark, out, stream, batch_id, STATE)
        totals, late = advance(batch, state)
        place = f"stream={stream}/batch_id={batch_id}"
        target = f"{out}/totals/{place}"
        totals.write.mode("overwrite").parquet(target)
        late.write.mode("overwrite").parquet(f"{out}/late/{place}")
        written = spark.read.schema(totals.schema).parquet(target)
        next_state(state, written).write.mode("overwrite").parquet(f"{out}/state/version={version}/{place}")
        forget(spark, out, version)

    return write
