"""Change capture: envelopes, unwrapping, current state, history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt.operators import ordered
from millwatt.session import written


def capture(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full-row change events between two snapshots of a table.

    One row per inserted (``c``), changed (``u``) or removed (``d``) key with both row images.
    """
    keys = list(keys)
    old = before.select(*keys, F.struct(*before.columns).alias("before"))
    new = after.select(*keys, F.struct(*after.columns).alias("after"))
    joined = old.join(new, keys, "full_outer")
    op = (
        F.when(F.col("before").isNull(), F.lit("c"))
        .when(F.col("after").isNull(), F.lit("d"))
        .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("u"))
    )
    return joined.withColumn("op", op).where(F.col("op").isNotNull())


def unwrap(envelopes: DataFrame) -> DataFrame:
    """Row image plus change columns: the after image, or for a delete the last known row."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return (
        envelopes.withColumn("_image", image)
        .select(
            "_image.*",
            F.col("op").alias("__op"),
            F.col("source.ts_ms").alias("__source_ts_ms"),
            F.col("source.lsn").alias("__lsn"),
            F.when(F.col("op") == "d", F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
        )
    )


def current(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("__source_ts_ms", "__lsn"),
    keep_deleted: bool = False,
) -> DataFrame:
    """State after all changes: latest row per key, deleted keys dropped unless asked for."""
    latest = ordered.latest_per_key(changes, keys, order)
    if keep_deleted:
        return latest
    return latest.where(~is_delete())


def is_delete() -> Column:
    """Whether a change row removes its key."""
    return F.coalesce((F.col("__op") == "d") | (F.col("__deleted") == "true"), F.lit(False))


def target_table(topic: Column) -> Column:
    """Table a change topic is written to; other topics keep their name."""
    found = F.regexp_extract(topic, C.CHANGE_TOPIC_PATTERN, 1)
    return F.when(topic.rlike(f"^{C.CHANGE_TOPIC_PATTERN}$"), found).otherwise(topic)


def evolve(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns were added over time; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def history(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    ties: Sequence[str] = (),
    **chunking,
) -> DataFrame:
    """Validity intervals of the tracked columns, one row per actual change.

    ``valid_to`` is null and ``is_current`` true on the last version. Works from the change log, as
    a compacted table has lost the versions.
    """
    order = [time, *ties]
    state = F.struct(*tracked)
    seen = ordered.previous(changes, keys, order, {"_state": state}, **chunking)
    changed = seen.where(F.col("_state").isNull() | ~F.col("_state").eqNullSafe(state)).drop("_state")
    bounded = ordered.following(changed, keys, order, {"valid_to": F.col(time)})
    return bounded.drop(ordered.CHUNK).withColumnRenamed(time, "valid_from").withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def timeline(
    points: DataFrame, keys: Sequence[str], tracked: Sequence[str], time: str, ties: Sequence[str] = (), **chunking
) -> DataFrame:
    """All changes with ``is_change`` (the tracked columns differ from the change before) and, for those, ``valid_to``.

    :func:`history` without losing the changes that repeat a state. The marks are worked out and written when the
    function is called.
    """
    order = [time, *ties]
    state = F.struct(*tracked)
    seen = ordered.previous(points, keys, order, {"_state": state}, **chunking)
    marked = seen.withColumn("is_change", F.col("_state").isNull() | ~F.col("_state").eqNullSafe(state)).drop("_state")
    marked = written(marked, "timeline")
    bounded = ordered.following(marked.where("is_change"), keys, order, {"valid_to": F.col(time)})
    rest = marked.where("not is_change").withColumn("valid_to", F.lit(None).cast("timestamp"))
    return bounded.unionByName(rest).drop(ordered.CHUNK)
