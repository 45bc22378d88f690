"""Thin adapters to a JDBC database; they need its driver on the class path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt.operators import landing
from millwatt.streaming.runs import stream_id

BATCH_ROWS = 200


def raw_sink(url: str, table: str, quarantine_path: str, checkpoint: str, **options: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends records as JSON text, ``BATCH_ROWS`` per statement.

    The database must accept text for its JSON columns (``stringtype=unspecified`` for Postgres). Rejected
    records are written to ``quarantine_path`` under the stream's and the batch's id. A batch that is run again
    is appended again: rows carry a message id (given to those that came without), so the table needs a unique
    index on it with an insert that ignores copies, or readers that remove them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"stream={stream_id(batch.sparkSession, checkpoint)}/batch_id={batch_id}"
        bad = landing.quarantined(batch).withColumn("value", F.to_json("value"))
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/{place}")
        rows = landing.land_json(landing.identified(landing.accepted(batch)))
        settings = {"url": url, "dbtable": table, "batchsize": str(BATCH_ROWS), **options}
        rows.write.format("jdbc").mode("append").options(**settings).save()

    return write


def read_table(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """A table read in ``parts`` ranges of a numeric key, so no single task reads it all."""
    ranges = {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **ranges, **options).load()
