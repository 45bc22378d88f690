"""A keyed table kept as a base plus change batches.

A batch only appends its own changes (latest per key), in a folder named by its stream and batch id, so
a repeated batch replaces itself, no batch rewrites the table, and a stream with a new checkpoint adds to
what others appended. Readers take the latest row per key over the base and the batches it does
not cover; a compaction now and then writes the next base together with the list of what it covers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt.operators import changes, ordered
from millwatt.sources.files import delete_folder, exists, numbered_folders, or_empty
from millwatt.streaming.runs import stream_id

ORDER = ("__source_ts_ms", "__lsn")
COVERED = "stream string, batch_id bigint"


class ChangeTable:
    """Current state of one captured table under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], schema: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.keys = list(keys)
        self.schema = f"{schema}, __op string, __source_ts_ms bigint, __lsn bigint, __deleted string"

    def append(self, batch: DataFrame, batch_id: int, stream: str = "batch") -> None:
        """Store the latest change per key of one batch of one stream."""
        latest = ordered.latest_per_key(batch, self.keys, ORDER)
        latest.write.mode("overwrite").parquet(f"{self.folder}/changes/stream={stream}/batch_id={int(batch_id)}")

    def sink(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function of a stream that keeps its progress in ``checkpoint``."""
        return lambda batch, batch_id: self.append(batch, batch_id, stream_id(self.spark, checkpoint))

    def current(self, keep_deleted: bool = False) -> DataFrame:
        version = self._version()
        stored = self._changes().where(~self._covered(version)).drop("stream", "batch_id")
        if version >= 0:
            base = self.spark.read.schema(self.schema).parquet(f"{self.folder}/base/version={version}/rows")
            stored = base.unionByName(stored)
        return changes.current(stored, self.keys, ORDER, keep_deleted)

    def compact(self) -> int:
        """Write a base that covers all batches so far; returns its version, -1 while nothing was appended."""
        version = self._version()
        # Folder names only: at most one row per batch since the last cleaning.
        listed = self._changes().where(~self._covered(version)).select("stream", "batch_id").distinct()
        fresh = listed.groupBy("stream").agg(F.max("batch_id").alias("batch_id")).collect()
        if not fresh:
            return version
        covered = self._limits(version) | {r.stream: r.batch_id for r in fresh}
        upto = self._changes().where(self._within(covered)).drop("stream", "batch_id")
        if version >= 0:
            upto = upto.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.folder}/base/version={version}/rows"))
        target = f"{self.folder}/base/version={version + 1}"
        changes.current(upto, self.keys, ORDER, keep_deleted=True).write.mode("overwrite").parquet(f"{target}/rows")
        # Readers take a base once its list is there.
        self.spark.createDataFrame(list(covered.items()), COVERED).write.mode("overwrite").parquet(f"{target}/covered")
        return version + 1

    def clean(self) -> None:
        """Remove batches and bases that the newest base covers; run it when no reader is on them."""
        version = self._version()
        for stream, last in self._limits(version).items():
            for number, folder in numbered_folders(self.spark, f"{self.folder}/changes/stream={stream}/batch_id=*").items():
                if number <= last:
                    delete_folder(self.spark, folder)
        for number, folder in numbered_folders(self.spark, f"{self.folder}/base/version=*").items():
            if number < version:
                delete_folder(self.spark, folder)

    def _version(self) -> int:
        """Newest base that was written to its end, -1 without one."""
        bases = numbered_folders(self.spark, f"{self.folder}/base/version=*")
        return max((n for n in bases if exists(self.spark, f"{bases[n]}/covered/_SUCCESS")), default=-1)

    def _limits(self, version: int) -> dict[str, int]:
        """Last batch of each stream that a base covers: a row for each checkpoint that ever wrote."""
        if version < 0:
            return {}
        rows = self.spark.read.schema(COVERED).parquet(f"{self.folder}/base/version={version}/covered").collect()
        return {r.stream: r.batch_id for r in rows}

    @staticmethod
    def _within(limits: dict[str, int]) -> Column:
        """Condition on the folder columns, so that covered folders are not read."""
        inside = F.lit(False)
        for stream, last in limits.items():
            inside = inside | ((F.col("stream") == stream) & (F.col("batch_id") <= last))
        return inside

    def _covered(self, version: int) -> Column:
        return self._within(self._limits(version))

    def _changes(self) -> DataFrame:
        schema = f"{self.schema}, {COVERED}"
        return or_empty(self.spark, lambda: self.spark.read.schema(schema).parquet(f"{self.folder}/changes"), schema)
