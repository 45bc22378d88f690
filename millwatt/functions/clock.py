"""Calendar, minute-of-day and shift arithmetic (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C


def minute_of_day(time: Column) -> Column:
    return F.hour(time) * 60 + F.minute(time)


def minutes_between(end: Column, start: Column) -> Column:
    """Length in minutes, fractions kept."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60e6)


def hours_between(end: Column, start: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3600e6)


def in_shift(hour: Column, start: Column, end: Column) -> Column:
    """True where ``hour`` is in ``[start, end)``; a shift may run past midnight."""
    plain = (start <= hour) & (hour < end)
    wrapped = (hour >= start) | (hour < end)
    return F.when(start <= end, plain).otherwise(wrapped)


def shift_date(time: Column, start: Column, end: Column) -> Column:
    """Day a shift belongs to: after midnight it is still the day the shift began."""
    day = F.to_date(time)
    return F.when((start > end) & (F.hour(time) < end), F.date_sub(day, 1)).otherwise(day)


def newest_time(df: DataFrame, ahead: str = C.LARGEST_CLOCK_LEAD) -> Column:
    """Time of the newest row that is at most ``ahead`` in the future, as a scalar subquery.

    Rows of a broken clock do not count, so one of them cannot expire a table or empty a panel. A
    table by day is read for its last day only.
    """
    latest = F.current_timestamp() + F.expr(f"INTERVAL {ahead}")
    df = df.where(F.col("time") <= latest)
    if "date" in df.columns:
        df = df.where(F.col("date") <= F.to_date(latest))
        df = df.where(F.col("date") == df.agg(F.max("date").alias("d")).scalar())
    return df.agg(F.max("time").alias("t")).scalar()


def since(df: DataFrame, limit: Column) -> Column:
    """Condition ``time >= limit``, also on the day column of a table by day so that days are pruned."""
    inside = F.col("time") >= limit
    if "date" in df.columns:
        inside = inside & (F.col("date") >= F.to_date(limit))
    return inside
