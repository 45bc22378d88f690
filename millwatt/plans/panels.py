"""Dashboard panels: rolling range, one-minute buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt.functions.clock import newest_time, since
from millwatt.functions.numeric import mean


def recent(df: DataFrame, hours: int = 24, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (the newest row).

    The limit is a scalar subquery or a literal, so it reaches the scan as a plain comparison.
    """
    if as_of is None:
        as_of = newest_time(df)
    return df.where(since(df, as_of - F.expr(f"INTERVAL {int(hours)} HOURS")))


def between_time(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of ``[start, end)``, with the same limits on the ``date`` partition column."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    inside = (F.col("time") >= first) & (F.col("time") < last)
    return df.where(inside & F.col("date").between(F.to_date(first), F.to_date(last)))


def _bucketed(df: DataFrame, by: str, bucket: str, **measures: Column) -> DataFrame:
    return df.groupBy(F.date_trunc(bucket, "time").alias("bucket"), by).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )


def supply_temp(stg: DataFrame, bucket: str = "minute", **window) -> DataFrame:
    rows = recent(stg, **window).where(F.col("ahu_supply_temp").isNotNull())
    return _bucketed(rows, "building", bucket, avg_supply_temp=mean(F.col("ahu_supply_temp")))


def return_temp(stg: DataFrame, bucket: str = "minute", **window) -> DataFrame:
    rows = recent(stg, **window).where(F.col("ahu_return_temp").isNotNull())
    return _bucketed(rows, "building", bucket, avg_return_temp=mean(F.col("ahu_return_temp")))


def chiller_delta(stg: DataFrame, bucket: str = "minute", **window) -> DataFrame:
    """Mean return minus supply of readings that have both."""
    gap = F.col("chiller_cwr_temp") - F.col("chiller_cws_temp")
    rows = recent(stg, **window).where(gap.isNotNull())
    return _bucketed(rows, "building", bucket, avg_delta_temp=mean(gap))


def power_by_building(stg: DataFrame, bucket: str = "minute", **window) -> DataFrame:
    rows = recent(stg, **window).where(F.col("total_power").isNotNull())
    return _bucketed(rows, "building", bucket, total_power=F.sum("total_power"))


def power_by_type(stg: DataFrame, bucket: str = "minute", **window) -> DataFrame:
    rows = recent(stg, **window).where(F.col("total_power").isNotNull())
    return _bucketed(rows, "equipment_type", bucket, total_power=F.sum("total_power"))


def cumulative_energy(stg: DataFrame, bucket: str = "minute", **window) -> DataFrame:
    """Last counter reading of every machine and bucket."""
    rows = recent(stg, **window).where(F.col("total_energy").isNotNull())
    last = F.max_by("total_energy", F.struct("time", "msg_id"))
    return _bucketed(rows, "device_name", bucket, total_energy=last)


def freshness(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("readings"), F.max("time").alias("newest"))
