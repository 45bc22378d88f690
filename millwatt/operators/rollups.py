"""Time-bucket aggregates of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatt.functions.numeric import ratio



def by_minute(energy: DataFrame) -> DataFrame:
    """Per device and minute: count, sum, least and greatest power, energy used.

    Sums and counts are kept beside the average so coarser buckets can be built from this one.
    """
    return _finish(
        energy.groupBy("device_id", F.date_trunc("minute", "time").alias("bucket")).agg(
            F.count("total_power").alias("readings"),
            F.sum("total_power").alias("power_sum"),
            F.min("total_power").alias("power_min"),
            F.max("total_power").alias("power_max"),
            F.sum("delta_kwh_reset_safe").alias("kwh"),
        )
    )


def by_hour(minutes: DataFrame) -> DataFrame:
    """Minute buckets to hours; reads the rolled-up rows, not the readings."""
    return _finish(
        minutes.groupBy("device_id", F.date_trunc("hour", "bucket").alias("bucket")).agg(
            F.sum("readings").alias("readings"),
            F.sum("power_sum").alias("power_sum"),
            F.min("power_min").alias("power_min"),
            F.max("power_max").alias("power_max"),
            F.sum("kwh").alias("kwh"),
        )
    )


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("power_avg", ratio(F.col("power_sum"), F.col("readings")))
