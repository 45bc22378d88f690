"""Joins beyond plain equality, and joins written so that a hot key can be split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatt.functions.clock import in_shift, shift_date
from millwatt.operators import ordered
from millwatt.session import written

# Points in a tile of the interval join.
TILE = 64


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    right_tie: str | None = None,
    how: str = "left",
    **chunking,
) -> DataFrame:
    """For every left row the latest right row of its key that is not later.

    Both sides are stacked and the latest right row is carried forward. Right columns come back in
    the struct ``matched``; right rows at the same instant count as known.
    """
    keys = list(keys)
    right = right.dropna(subset=keys)
    left_row = F.struct(*left.columns)
    right_row = F.struct(*right.columns)
    tie = F.col(right_tie) if right_tie else F.lit(0)
    tie_type = right.schema[right_tie].dataType if right_tie else "int"
    stacked = right.select(
        *keys,
        F.col(right_time).alias("_time"),
        F.lit(0).alias("_side"),
        tie.alias("_tie"),
        F.lit(None).cast(left.schema).alias("_left"),
        right_row.alias("_right"),
    ).unionByName(
        left.select(
            *keys,
            F.col(left_time).alias("_time"),
            F.lit(1).alias("_side"),
            F.lit(None).cast(tie_type).alias("_tie"),
            left_row.alias("_left"),
            F.lit(None).cast(right.schema).alias("_right"),
        )
    )
    carried = ordered.last_known(
        stacked, keys, ["_time", "_side", "_tie"], "matched", F.col("_right"), **chunking
    ).where(F.col("_side") == 1)
    if how == "inner":
        carried = carried.where(F.col("matched").isNotNull())
    return carried.select("_left.*", "matched")


def within_interval(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    tie: str | None = None,
    tile: int = TILE,
    **chunking,
) -> DataFrame:
    """Points that fall in ``[start, end)`` of an interval of their key; a null end is open.

    A sweep: begins, ends and points of a key are stacked in order of time, and a running count numbers the points. The points of
    an interval are then the numbers from the count at its begin up to the one at its end, whatever the lengths and
    overlaps. Numbers are cut into tiles; an interval meets the tiles it covers by equality on key and tile. Tiles
    inside an interval hold ``tile`` points that all match, so work follows the result, and a hot key is many tiles.
    Intervals without a point end before they are joined.

    A point in several intervals comes out once for each; equal intervals count each. Interval columns, which must be of types that
    can be grouped, come back in the struct ``matched``. Points and intervals with a null key or time match nothing.
    The order of intervals of one begin does not matter, so ``tie`` has no effect. The count is worked out and written
    when the function is called.
    """
    keys = list(keys)
    columns = [F.col(k) for k in keys]
    point, interval = F.struct(*points.columns), F.struct(*intervals.columns)
    no_point, no_interval = F.lit(None).cast(points.schema), F.lit(None).cast(intervals.schema)
    last = F.coalesce(F.col(end).cast("timestamp"), F.lit("9999-12-31").cast("timestamp"))
    edge = F.explode(F.array(F.struct(F.col(start).cast("timestamp").alias("at"), F.lit(True).alias("opens")), F.struct(last.alias("at"), F.lit(False).alias("opens"))))
    edges = (
        intervals.dropna(subset=[*keys, start])
        .where(F.col(end).isNull() | (F.col(end) > F.col(start)))
        .select(*columns, interval.alias("_interval"), edge.alias("_edge"))
        .select(*keys, F.col("_edge.at").alias("_at"), F.lit(0).alias("_point"), no_point.alias("_row"), "_interval", F.col("_edge.opens").alias("_opens"))
    )
    # Edges come before the points of their instant: a begin counts them in, an end does not.
    stacked = edges.unionByName(
        points.dropna(subset=[*keys, time]).select(
            *columns, F.col(time).cast("timestamp").alias("_at"), F.lit(1).alias("_point"), point.alias("_row"), no_interval.alias("_interval"), F.lit(None).cast("boolean").alias("_opens")
        )
    )
    counted = ordered.running_sum(stacked, keys, ["_at", "_point"], {"_count": F.col("_point").cast("bigint")}, **chunking)
    # Sorted once; intervals and points are both taken from it.
    counted = written(counted.drop(ordered.CHUNK), "sweep")
    spans = (
        counted.where("_point = 0")
        .groupBy(*keys, "_interval")
        .agg(
            F.min(F.when(F.col("_opens"), F.col("_count"))).alias("_from"),
            F.max(F.when(~F.col("_opens"), F.col("_count"))).alias("_upto"),
            F.count_if("_opens").alias("_copies"),
        )
        .where("_upto > _from")
    )
    tiles = F.sequence(F.floor(F.col("_from") / tile), F.floor((F.col("_upto") - 1) / tile))
    laid = spans.select(*keys, "_interval", "_from", "_upto", "_copies", F.explode(tiles).alias("_tile"))
    numbered = counted.where("_point = 1").select(*keys, "_row", (F.col("_count") - 1).alias("_number"))
    met = numbered.withColumn("_tile", F.floor(F.col("_number") / tile)).join(laid, [*keys, "_tile"])
    inside = met.where((F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_upto")))
    each = inside.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return each.select("_row.*", F.col("_interval").alias("matched"))


def with_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Left outer join of parents to any number of children.

    Adaptive execution can split a hot key on either side of an inner join but not on the right of
    a left outer join, so childless parents are found against the distinct keys and added.
    """
    matched = parents.join(children, parents[parent_key] == children[child_key])
    known = children.select(F.col(child_key).alias("_known")).distinct()
    childless = parents.join(known, parents[parent_key] == known["_known"], "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)


def shift_hours(shifts: DataFrame) -> DataFrame:
    """One row per shift and hour of day it covers: at most 24 rows per shift."""
    hours = shifts.withColumn("hour_of_day", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return hours.where(in_shift(F.col("hour_of_day"), F.col("start_hour"), F.col("end_hour")))


def with_shift(df: DataFrame, shifts: DataFrame, time: str) -> DataFrame:
    """Shift and shift day of every row, by the hour of ``time``.

    The range condition becomes an equality on the hour. The shifts are gathered to one row per
    hour, 24 at most, which bounds the broadcast. A row in an hour that no shift covers keeps its day and
    has no shift; rows without a time are dropped.
    """
    per_hour = (
        shift_hours(shifts)
        .groupBy("hour_of_day")
        .agg(F.collect_list(F.struct("shift_id", "shift_code", "start_hour", "end_hour")).alias("_shifts"))
    )
    placed = df.where(F.col(time).isNotNull()).withColumn("hour_of_day", F.hour(time))
    joined = placed.join(F.broadcast(per_hour), "hour_of_day", "left").select(*df.columns, F.inline_outer("_shifts"))
    return joined.withColumn(
        "shift_date", shift_date(F.col(time), F.col("start_hour"), F.col("end_hour"))
    ).drop("start_hour", "end_hour")
