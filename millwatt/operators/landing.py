"""From wire records to the raw telemetry table, and its upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.functions import labels, maps
from millwatt.functions.clock import newest_time, since


def from_text_members(events: DataFrame) -> DataFrame:
    """Events whose reading map holds text: number members are kept, others listed in ``bad_keys``."""
    return events.withColumn("bad_keys", maps.bad_members(F.col("value"))).withColumn(
        "value", maps.numeric_members(F.col("value"))
    )


def reject_reason(latest: Column | None = None) -> Column:
    """Why a decoded record cannot be landed; null for a good one.

    ``latest`` is the latest event time that is believed; one broken clock would otherwise move "now" for
    retention and every rolling panel.
    """
    reason = (
        F.when(F.col("deviceId").isNull(), F.lit("missing deviceId"))
        .when(F.col("ts_utc").isNull(), F.lit("missing ts_utc"))
        .when(F.col("value").isNull(), F.lit("missing value"))
        .when(F.col("metadata").isNull(), F.lit("missing metadata"))
        .when(F.col("metadata")["deviceId"].isNull(), F.lit("missing metadata deviceId"))
    )
    return reason if latest is None else reason.when(F.timestamp_millis("ts_utc") > latest, F.lit("time in the future"))


def quarantine_reason(latest: Column | None = None) -> Column:
    """Reject reason, or the bad members of a record that is landed without them."""
    bad = F.when(
        F.size("bad_keys") > 0, F.concat(F.lit("bad value: "), F.array_join("bad_keys", ","))
    )
    return F.coalesce(reject_reason(latest), bad)


def accepted(events: DataFrame, latest: Column | None = None) -> DataFrame:
    return events.where(reject_reason(latest).isNull())


def quarantined(events: DataFrame, latest: Column | None = None) -> DataFrame:
    """Rejected records and records that lost members, with the reason and all their columns."""
    return events.withColumn("reason", quarantine_reason(latest)).where(F.col("reason").isNotNull())


def land(events: DataFrame) -> DataFrame:
    """Raw telemetry rows: event time, three maps, and the columns generated from metadata."""
    time = F.timestamp_millis("ts_utc")
    return events.select(
        time.alias("time"),
        "value",
        maps.dimensions(F.col("building"), F.col("equipmentType"), F.col("deviceId")).alias("dimensions"),
        "metadata",
        F.col("metadata")["deviceId"].alias("device_id"),
        F.col("metadata")["source"].alias("source"),
        F.to_date(time).alias("date"),
    )


def land_json(events: DataFrame) -> DataFrame:
    """The same rows with the maps as JSON text, as a JDBC sink takes them."""
    return events.select(
        F.timestamp_millis("ts_utc").alias("time"),
        maps.values_json(F.col("value")).alias("value"),
        maps.dimensions_json(F.col("building"), F.col("equipmentType"), F.col("deviceId")).alias("dimensions"),
        maps.metadata_json(F.col("metadata")).alias("metadata"),
    )


def route_topics(events: DataFrame) -> DataFrame:
    """Add the topic a record of this source and type belongs to."""
    return events.withColumn("topic", labels.topic(F.col("source"), F.col("equipmentType")))


def identified(events: DataFrame) -> DataFrame:
    """Fill a missing message id with a digest of the record, so replays get the same id and are removed as copies."""
    digest = F.sha2(
        F.concat_ws(
            "|", "deviceId", F.col("ts_utc").cast("string"), F.to_json(F.array_sort(F.map_entries("value")))
        ),
        256,
    )
    others = F.map_filter(F.col("metadata"), lambda k, _: k != "msgId")
    named = F.map_concat(others, F.create_map(F.lit("msgId"), digest))
    # A map that holds an id stays as it is, so that readers of the id do not build it.
    has_id = F.col("metadata")["msgId"].isNotNull()
    return events.withColumn("metadata", F.when(has_id, F.col("metadata")).otherwise(named))


content_id = identified


def newest_day(raw: DataFrame, days: int) -> Column:
    """Day ``days`` before the newest row, as a scalar subquery."""
    return F.date_sub(F.to_date(newest_time(raw)), days)


def within_retention(raw: DataFrame, days: int = C.RETAIN_DAYS, as_of: Column | None = None) -> DataFrame:
    """Rows kept by the retention rule: not older than ``days`` before ``as_of`` (newest row)."""
    if as_of is None:
        as_of = newest_time(raw)
    return raw.where(since(raw, as_of - F.expr(f"INTERVAL {int(days)} DAYS")))


def compaction_candidates(raw: DataFrame, days: int = C.COMPACT_AFTER_DAYS) -> DataFrame:
    """Days old enough to be compacted, with their size."""
    per_day = raw.groupBy(F.to_date("time").alias("date")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("device_id").alias("devices")
    )
    return per_day.where(F.col("date") < newest_day(raw, days))


def dedupe(raw: DataFrame, msg_id: Column | None = None) -> DataFrame:
    """One row per message id, the earliest; rows without an id are all kept.

    Replays are the exception, so ids alone are counted first, map-side. Full rows are shuffled once and looked up in a
    hash table of the repeated ids of their partition, so none but the copies are sorted. Ids meet null-safe, so
    that the repeated ones are worked out once, in a stage of their own.
    """
    key = F.col("metadata")["msgId"] if msg_id is None else msg_id
    keyed = raw.withColumn("_msg", key)
    counts = keyed.where(F.col("_msg").isNotNull()).groupBy("_msg").agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.where("_n > 1").select(F.col("_msg").alias("_again")).hint("shuffle_hash")
    met = F.col("_msg").eqNullSafe(F.col("_again"))
    single = keyed.join(repeated, met, "left_anti").select(*raw.columns)
    earliest = F.min_by(F.struct(*raw.columns), F.struct("time", "device_id"))
    copies = keyed.join(repeated, met, "left_semi").groupBy("_msg").agg(earliest.alias("_row"))
    return single.unionByName(copies.select("_row.*"))
