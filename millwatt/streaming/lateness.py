"""Late-data audit over micro-batches: rows far behind the newest time that arrived before them.

The newest time of earlier batches is the whole state. Within a batch the batch operator decides, by arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatt import constants as C
from millwatt.operators import signals
from millwatt.streaming.runs import before, forget, stream_id

STATE = "newest timestamp"


def start(
    arrivals: DataFrame, out: str, checkpoint: str, lateness_seconds: int = C.LATENESS_SECONDS, trigger: dict | None = None
) -> StreamingQuery:
    """``arrivals`` holds ``arrival`` (a serial number) and ``time``; late rows go to ``out/late``."""
    return (
        arrivals.writeStream.foreachBatch(_writer(out, checkpoint, lateness_seconds))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


def late_in(batch: DataFrame, newest: DataFrame, lateness_seconds: int) -> DataFrame:
    """Late rows of a batch after earlier ones whose ``newest`` time is known, if any."""
    known = newest.agg(F.max("newest").alias("t")).scalar()
    first = batch.agg((F.min("arrival") - 1).alias("a")).scalar()
    seed = newest.select(first.alias("arrival"), known.alias("time"), F.lit(True).alias("_seed")).where("arrival is not null")
    rows = batch.select("arrival", "time").withColumn("_seed", F.lit(False)).unionByName(seed)
    return signals.late_rows(rows, "arrival", lateness_seconds=lateness_seconds).where("not _seed").drop("_seed")


def _writer(out: str, checkpoint: str, lateness_seconds: int) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        version, state = before(spark, out, stream, batch_id, STATE)
        place = f"stream={stream}/batch_id={batch_id}"
        late_in(batch, state, lateness_seconds).write.mode("overwrite").parquet(f"{out}/late/{place}")
        newest = batch.select(F.col("time").alias("newest")).unionByName(state).agg(F.max("newest").alias("newest"))
        newest.write.mode("overwrite").parquet(f"{out}/state/version={version}/{place}")
        forget(spark, out, version)

    return write
