"""Messages that come again after the watermark, found by an index of the ids that were landed.

The index is a table of message ids by event day and hash bucket, written in a folder per stream and batch like the landing
itself. A batch meets the ids of its own days only, leaves out its own folder, and replaces that folder when it is run again; so a
repeated batch finds what it found the first time, and a stream with a new checkpoint that reads everything again lands
nothing twice. A replay carries the time of the message it repeats, so it meets the day it was indexed under.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwatt.sources.files import delete_folder, folders, or_empty

BUCKETS = 16
SCHEMA = "msg_id string, stream string, batch_id bigint, day date, bucket int"
# Most ids that are sent to every task; rows meet a longer list by a shuffle.
FEW = 100_000
VERDICTS = "id string, day date, verdict string"
# What becomes of the rows of an id and a day: landed, landed once, left out, landed for want of an id.
ALONE, SEVERAL, KNOWN, UNNAMED = "alone", "several", "known", "unnamed"


class ReplayIndex:
    """Ids of landed messages under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def ids(self) -> DataFrame:
        return or_empty(self.spark, lambda: self.spark.read.schema(SCHEMA).parquet(self.folder), SCHEMA)

    def _bucket(self, msg_id: Column) -> Column:
        return F.pmod(F.xxhash64(msg_id), F.lit(self.buckets)).cast("int")

    def _judged(self, stream: str, batch_id: int) -> str:
        """Folder of a batch's verdicts, which is gone once the batch is indexed; readers of the index skip its name."""
        return f"{self.folder}/_judged/stream={stream}/batch_id={batch_id}"

    def _verdicts(self, raw: DataFrame, stream: str, batch_id: int) -> DataFrame:
        """What becomes of each id and day of a batch; a row of an id that comes on several days is landed on the first new one."""
        days = [r[0] for r in raw.select("date").distinct().collect()]  # one row a day
        ours = (F.col("stream") == stream) & (F.col("batch_id") >= batch_id)
        # Day is a folder column: other days are not read.
        known = self.ids().where(F.col("day").isin(days) & ~ours & F.col("msg_id").isNotNull())
        here = raw.select(F.col("metadata")["msgId"].alias("id"), F.col("date").alias("day"), F.lit(1).alias("rows"))
        both = here.unionByName(known.select(F.col("msg_id").alias("id"), "day", F.lit(0).alias("rows")))
        counted = both.groupBy("id", "day").agg(F.sum("rows").alias("rows"), (F.min("rows") == 0).alias("known")).where("rows > 0")
        place = F.row_number().over(Window.partitionBy("id").orderBy("known", F.asc_nulls_first("day")))
        verdict = (
            F.when(F.col("id").isNull(), UNNAMED)
            .when(F.col("known") | (place > 1), KNOWN)
            .when(F.col("rows") > 1, SEVERAL)
            .otherwise(ALONE)
        )
        return counted.select("id", "day", verdict.alias("verdict"))

    def fresh(self, raw: DataFrame, stream: str, batch_id: int) -> DataFrame:
        """Raw rows of a batch that neither an earlier batch nor another row of this one holds.

        Of the rows of one id the earliest is taken, so it is of the id's first day, as ``date`` is the day of ``time``. Ids and days
        alone are judged, and counted, first. Whole rows then meet the shorter list, that of the ids to land or that of the others:
        not at all while it is empty, in place while it is short, by a shuffle beyond.
        """
        judged = self._judged(stream, batch_id)
        self._verdicts(raw, stream, batch_id).write.mode("overwrite").partitionBy("verdict").parquet(judged)
        verdicts = self.spark.read.schema(VERDICTS).parquet(judged)
        many = {r.verdict: r["count"] for r in verdicts.groupBy("verdict").count().collect()}
        alone, several = many.get(ALONE, 0), many.get(SEVERAL, 0)
        others = several + many.get(KNOWN, 0)
        msg_id = F.col("metadata")["msgId"]
        same = (msg_id == F.col("id")) & F.col("date").eqNullSafe(F.col("day"))

        def met(which: tuple[str, ...], count: int, how: str) -> DataFrame:
            listed = verdicts.where(F.col("verdict").isin(*which)).select("id", "day")
            return raw.join(listed.hint("broadcast" if count <= FEW else "shuffle_hash"), same, how)

        if not others:
            return raw
        if others <= alone:
            landed = met((SEVERAL, KNOWN), others, "left_anti")  # keeps the rows without an id
        else:
            landed = met((ALONE,), alone, "left_semi")
            landed = landed.unionByName(raw.where(msg_id.isNull())) if UNNAMED in many else landed
        if several:
            earliest = F.min_by(F.struct(*raw.columns), F.struct("time", "device_id"))
            copies = met((SEVERAL,), several, "left_semi").groupBy(msg_id.alias("id")).agg(earliest.alias("row"))
            landed = landed.unionByName(copies.select("row.*"))
        return landed

    def add(self, landed: DataFrame, stream: str, batch_id: int) -> None:
        """Index the ids of a batch that was landed."""
        msg_id = F.col("metadata")["msgId"]
        ids = landed.select(msg_id.alias("msg_id"), F.col("date").alias("day"), self._bucket(msg_id).alias("bucket"))
        target = f"{self.folder}/stream={stream}/batch_id={batch_id}"
        ids.hint("rebalance", "day", "bucket").write.mode("overwrite").partitionBy("day", "bucket").parquet(target)
        delete_folder(self.spark, self._judged(stream, batch_id))

    def forget(self, before: str) -> list[str]:
        """Remove the ids of days before ``before``: replays of them are not looked for any more."""
        old = [p for p in folders(self.spark, f"{self.folder}/stream=*/batch_id=*/day=*") if p.rstrip("/").rsplit("=", 1)[1] < before]
        for path in old:
            delete_folder(self.spark, path)
        return sorted({p.rstrip("/").rsplit("=", 1)[1] for p in old})
