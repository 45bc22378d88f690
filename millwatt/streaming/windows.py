"""Event-time windows and duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions.numeric import numeric

DELAY = f"{C.LATENESS_SECONDS} seconds"


def tumbling(stream: DataFrame, time: str = "time", length: str = "1 minute", delay: str = DELAY) -> DataFrame:
    """Per device and window: count, sum, least and greatest power.

    Works on a stream (append mode) and, without the watermark's effect, on a batch. Rows are merged
    before the shuffle, so a busy device costs one row per task and window.
    """
    power = numeric(F.col("value")["totalPower"])
    return (
        stream.withWatermark(time, delay)
        .groupBy("device_id", F.window(time, length))
        .agg(
            F.count(power).alias("readings"),
            F.sum(power).alias("power_sum"),
            F.min(power).alias("power_min"),
            F.max(power).alias("power_max"),
        )
        .select(
            "device_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "readings",
            "power_sum",
            "power_min",
            "power_max",
        )
    )


def deduplicated(
    stream: DataFrame, msg_id: str = "msg_id", time: str = "time", delay: str = DELAY, spread: int = 16
) -> DataFrame:
    """First copy of every message id within the watermark.

    Copies of one id may be a large share of a stream. They are first thinned on the id and a salt
    of the arrival position, which spreads a hot id over ``spread`` tasks, then on the id.
    """
    salted = stream.withWatermark(time, delay)
    if spread > 1 and "arrival" in stream.columns:
        salted = salted.withColumn("_salt", F.pmod(F.xxhash64("arrival"), F.lit(spread)))
        salted = salted.dropDuplicatesWithinWatermark([msg_id, "_salt"]).drop("_salt")
    return salted.dropDuplicatesWithinWatermark([msg_id])
