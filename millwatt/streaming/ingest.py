"""Landing stream: decode, set bad records aside, write the raw table. No late row is dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatt import constants as C
from millwatt import schemas
from millwatt.operators import landing
from millwatt.sources.telemetry import by_device
from millwatt.streaming.replays import ReplayIndex
from millwatt.streaming.runs import stream_id


def start(
    events: DataFrame,
    raw_path: str,
    quarantine_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    ahead: str = C.LARGEST_CLOCK_LEAD,
    index: ReplayIndex | None = None,
) -> StreamingQuery:
    """Land an event stream whose ``value`` map holds text or numbers.

    Each batch is written under the stream's id and its own batch id in both tables and replaces
    itself when it is run again, so a batch that fails half way leaves nothing behind or twice, and a
    stream with a new checkpoint adds to what others landed. Records more than ``ahead`` in the
    future are set aside. Columns beside the event's own, such as the message text, its topic and
    its offset, go to the quarantine as they are, so that a record can be replayed. With an ``index`` messages
    that were landed before, by any stream that shares it, are left out however late they come again.
    """
    parsed = landing.from_text_members(events.withColumn("value", F.col("value").cast("map<string,string>")))
    return (
        parsed.writeStream.foreachBatch(_writer(raw_path, quarantine_path, checkpoint, ahead, index))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


def _writer(
    raw_path: str, quarantine_path: str, checkpoint: str, ahead: str, index: ReplayIndex | None
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id(batch.sparkSession, checkpoint)
        place = f"stream={stream}/batch_id={batch_id}"
        latest = F.current_timestamp() + F.expr(f"INTERVAL {ahead}")
        # Read three times below: to sample the ranges, to write good rows, to write bad ones. A lost
        # executor's part of it is read from the source again.
        batch.persist()
        try:
            good = landing.land(landing.identified(landing.accepted(batch, latest)))
            if index:
                good = index.fresh(good, stream, batch_id)
            by_device(good).write.mode("overwrite").partitionBy("date").parquet(f"{raw_path}/{place}")
            if index:
                # From what was written, so that the two cannot differ. A batch that fails before this is run again.
                index.add(spark.read.schema(schemas.RAW_TELEMETRY).parquet(f"{raw_path}/{place}"), stream, batch_id)
            bad = landing.quarantined(batch, latest).withColumn("value", F.to_json("value"))
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/{place}")
        finally:
            batch.unpersist()

    return write
