"""Captured tables by bucket of keys: a batch of changes rewrites only the buckets that hold its keys.

:class:`KeyedTable` keeps the current state, :class:`HistoryTable` the validity intervals. Both take batches in any
order of their changes, and a batch that is run again does nothing. Fewer keys than a table's buckets cost a rewrite of few of them;
:class:`millwatt.sources.changelog.ChangeTable` suits tables of which every batch touches most keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt.operators import changes, ordered
from millwatt.session import written
from millwatt.sources.changelog import ORDER
from millwatt.sources.parts import PartTable
from millwatt.streaming.runs import stream_id

BUCKETS = 64


class _Bucketed:
    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], schema: str, buckets: int):
        self.spark, self.keys = spark, list(keys)
        self.table = PartTable(spark, folder, schema, {"buckets": str(buckets), "keys": ",".join(self.keys)})
        self.buckets = buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string").alias(PartTable.PART)

    def _touched(self, batch: DataFrame) -> list[str]:
        """The buckets with a key of the batch: at most ``buckets`` rows."""
        return [r[0] for r in batch.select(self._bucket()).distinct().collect()]

    def merge(self, batch: DataFrame, batch_id: int, stream: str = "batch") -> list[str]:
        """Apply a batch; returns the buckets that were rewritten."""
        if self.table.applied(stream, batch_id):
            return []
        fresh = self._prepared(batch).persist()  # read for its buckets and for the merge
        try:
            touched = self._touched(fresh)
            if touched:
                merged = self._merged(self.table.read(touched), fresh)
                self.table.replace(merged.withColumn(PartTable.PART, self._bucket()), touched, (stream, batch_id))
        finally:
            fresh.unpersist()
        return sorted(touched, key=int)

    def sink(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function of a stream that keeps its progress in ``checkpoint``."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.merge(batch, batch_id, stream_id(self.spark, checkpoint))

        return write


class KeyedTable(_Bucketed):
    """Current state of a captured table; ``schema`` has the columns of the row itself."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], schema: str, buckets: int = BUCKETS):
        full = f"{schema}, __op string, __source_ts_ms bigint, __lsn bigint, __deleted string"
        super().__init__(spark, folder, keys, full, buckets)

    def _prepared(self, batch: DataFrame) -> DataFrame:
        return ordered.latest_per_key(batch, self.keys, ORDER)

    def _merged(self, old: DataFrame, fresh: DataFrame) -> DataFrame:
        return ordered.latest_per_key(old.unionByName(fresh.select(*old.columns)), self.keys, ORDER)

    def current(self, keep_deleted: bool = False) -> DataFrame:
        rows = self.table.read()
        return rows if keep_deleted else rows.where(~changes.is_delete())


class HistoryTable(_Bucketed):
    """Validity intervals of tracked columns, kept up to date from batches of changes.

    Every change of a key is stored in its place, with a mark on those that changed something: a change that comes late may
    split an interval, and one that repeated the state before it may become a change of its own. Only
    keys of the batch are worked out anew; the other rows of their buckets are copied.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keys: Sequence[str],
        tracked: Sequence[str],
        time: str,
        ties: Sequence[str],
        schema: str,
        buckets: int = BUCKETS,
        **chunking,
    ):
        self.tracked, self.time, self.ties, self.chunking = list(tracked), time, list(ties), chunking
        super().__init__(spark, folder, keys, f"{schema}, is_change boolean, valid_to timestamp", buckets)

    def _columns(self) -> list[str]:
        return [*self.keys, *self.tracked, self.time, *self.ties]

    def _prepared(self, batch: DataFrame) -> DataFrame:
        return batch.select(*self._columns()).distinct()

    def _merged(self, old: DataFrame, fresh: DataFrame) -> DataFrame:
        # Keys alone are held in a hash table for each partition; the stored rows that meet them need no sort.
        affected = fresh.select(*self.keys).distinct().hint("shuffle_hash")
        others = old.join(affected, self.keys, "left_anti")
        points = old.join(affected, self.keys, "left_semi").select(*self._columns()).unionByName(fresh).distinct()
        points = written(points, "history-points")
        return others.unionByName(
            changes.timeline(points, self.keys, self.tracked, self.time, self.ties, **self.chunking).select(*old.columns)
        )

    def intervals(self) -> DataFrame:
        """``valid_from, valid_to, is_current`` of every state; as :func:`millwatt.operators.changes.history` gives."""
        rows = self.table.read().where("is_change").drop("is_change")
        return rows.withColumnRenamed(self.time, "valid_from").withColumn("is_current", F.col("valid_to").isNull())
