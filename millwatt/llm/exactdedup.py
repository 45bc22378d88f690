"""Exact deduplication of arriving batches against immutable snapshots screened by binary-fuse filters.

Texts are equal when identical after each run of ASCII blanks becomes one blank. A batch is first grouped by itself: digest and
bytes of the normalised text are the grouping key, merged in each task before they are shuffled, so a group of copies of any size
leaves a task as one row. The distinct texts of the batch are then screened against every earlier snapshot: the snapshot's
keys lie in buckets of about ``BUCKET_KEYS``, each with a static filter (see :mod:`.fuse`) built once; keys meet the
filter of their bucket in one task. Only positives join the snapshot's exact entries, where digest and bytes must both agree. A
text seen before is noted as a sighting of the entry; the others become the entries of the batch's own snapshot, which never changes.

Rows learn their class by digest. Classes that hold a thousandth of all rows or more, at most ``HOT`` of them, are broadcast; the
others are shuffled. Digests that stand for several texts (none, with whole sha256) take a join on the bytes as well.

Defined results: null counts as empty; texts of blanks only are equal to one blank, not to the empty text; a text of any length
is read whole; of equal texts the smallest id stays, a null id only when there is no other; rows alike in id and text stay or go
together; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from millwatt.session import work_folder

from . import fuse
from .stage import share, small, written
from .words import BLANK_CHARS

BUCKET_KEYS = 4096
HOT = 1000
HOT_ROWS = 32  # a class of fewer rows is never hot
DIGEST_BYTES = 32
_BLANKS = BLANK_CHARS.encode()


def normalise(text: bytes) -> bytes:
    """Each run of ASCII blanks as one blank; ``bytes.split`` splits at just these six."""
    if not text:
        return text
    inner = b" ".join(text.split())
    if not inner:
        return b" "
    return (b" " if text[0] in _BLANKS else b"") + inner + (b" " if text[-1] in _BLANKS else b"")


def digest(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id, sha`` (of the normalised text), ``digest`` (its beginning), ``key`` (64 bits of that) and ``packed`` (the text, compressed).

    Equal packed bytes mean equal texts, and the other way round, as the codec is a function.
    """

    def run(batches):
        codec = pa.Codec("zstd")
        for batch in batches:
            shas, keys, packed = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                text = normalise(text or b"")
                sha = hashlib.sha256(text).digest()
                shas.append(sha)
                keys.append(int.from_bytes(sha[: min(digest_bytes, 8)], "little", signed=True))
                packed.append(len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True))
            columns = [batch.column("doc_id"), pa.array(shas, pa.binary()), pa.array(keys, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sha", "key", "packed"])

    fields = [StructField("sha", BinaryType()), StructField("key", LongType()), StructField("packed", BinaryType())]
    made = docs.select("doc_id", "text").mapInArrow(run, StructType([docs.schema["doc_id"], *fields]))
    return made.select("doc_id", "sha", F.substring("sha", 1, digest_bytes).alias("digest"), "key", "packed")


def _bucket(buckets: int) -> Column:
    """High-quality bits for the bucket, apart from those that the filter uses."""
    return F.pmod(F.xxhash64("key", F.lit(41)), F.lit(buckets)).alias("bucket")


def filters(keys: DataFrame, buckets: int) -> DataFrame:
    """``bucket, filter``: one static filter for each bucket that has keys."""

    def build(table: pa.Table) -> pa.Table:
        made = fuse.build(table.column("key").to_numpy().view("uint64"))
        return pa.table({"bucket": table.column("bucket")[:1], "filter": pa.array([made], pa.binary())})

    return keys.select("key", _bucket(buckets)).groupBy("bucket").applyInArrow(build, "bucket long, filter binary")


def screen(keys: DataFrame, filter_table: DataFrame, buckets: int) -> DataFrame:
    """The keys that may be members."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.select(["key"]).slice(0, 0)
        hit = fuse.contains(right.column("filter")[0].as_py(), left.column("key").to_numpy().view("uint64"))
        return left.select(["key"]).filter(pa.array(hit))

    asked = keys.select("key", _bucket(buckets)).distinct().groupBy("bucket")
    return asked.cogroup(filter_table.groupBy("bucket")).applyInArrow(ask, "key long")


class Snapshots:
    """The snapshots under a folder: ``snapshot=n`` holds ``entries``, ``sightings`` and, written last, ``filters``.

    A snapshot without complete filters does not count and is written anew by the next batch.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.root, self.bucket_keys = spark, root.rstrip("/"), bucket_keys

    def _complete(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshot=*/filters/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(int(str(f.getPath()).split("snapshot=")[1].split("/")[0]) for f in found)

    def _read(self, number: int, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/snapshot={number}/{part}")

    def add(self, batch: DataFrame) -> int:
        """Ingest a batch (rows of :func:`digest`) as the next snapshot; returns its number."""
        known = self._complete()
        number = max(known, default=-1) + 1
        folder = f"{self.root}/snapshot={number}"
        texts = batch.groupBy("digest", "key", "packed").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
        if known:  # read for every earlier snapshot and for what is new
            texts = written(texts, "dedup-texts")
        sightings = [self._seen(texts, earlier) for earlier in known]
        seen = texts.select("digest", F.lit(0).alias("snapshot"), F.lit(0).cast("long").alias("entry"), "first_id", "copies", "packed").limit(0)
        for found in sightings:
            seen = seen.unionByName(found)
        seen.write.mode("overwrite").parquet(f"{folder}/sightings")
        new = texts
        if known:
            gone = self._read(number, "sightings").select("digest", "packed")
            new = texts.join(gone, ["digest", "packed"], "left_anti")
        new.withColumn("entry", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{folder}/entries")
        keys = self._read(number, "entries").select("key")
        buckets = keys.count() // self.bucket_keys + 1
        made = filters(keys, buckets).withColumn("buckets", F.lit(buckets).cast("long"))
        made.write.mode("overwrite").parquet(f"{folder}/filters")
        return number

    def _seen(self, texts: DataFrame, earlier: int) -> DataFrame:
        """Texts of the batch that the snapshot holds, with its entry: positives of the filters, checked by their bytes."""
        filter_table = self._read(earlier, "filters")
        first = filter_table.first()
        buckets = first.buckets if first else 1
        positives = written(screen(texts, filter_table.select("bucket", "filter"), buckets), "dedup-positives")
        entries = self._read(earlier, "entries").select("digest", "packed", "entry", "key")
        asked = texts.join(positives, "key", "left_semi").drop("key")
        held = entries.join(positives, "key", "left_semi").drop("key")
        same = asked.join(held, ["digest", "packed"])
        return same.select("digest", F.lit(earlier).alias("snapshot"), "entry", "first_id", "copies", "packed")

    def classes(self) -> DataFrame:
        """``digest, snapshot, entry, keep_id, group_size``: one row for each distinct text of all batches."""
        parts = []
        for number in self._complete():
            own = self._read(number, "entries").select("digest", F.lit(number).alias("snapshot"), "entry", "first_id", "copies")
            parts += [own, self._read(number, "sightings").drop("packed")]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every.groupBy("digest", "snapshot", "entry").agg(F.min("first_id").alias("keep_id"), F.sum("copies").alias("group_size"))

    def judge(self, rows: DataFrame) -> DataFrame:
        """``doc_id, sha, keep_id, group_size`` of rows of :func:`digest` that were added; ``rows`` is a written table."""
        classes = written(self.classes(), "dedup-classes")
        shared = written(classes.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "dedup-shared")
        outcome = ["doc_id", "sha", "keep_id", "group_size"]
        several = not shared.isEmpty()
        single = classes.join(shared, "digest", "left_anti") if several else classes
        least = max(rows.count() // HOT, HOT_ROWS)
        # At most ``HOT`` classes have so many rows.
        hot = F.broadcast(single.where(F.col("group_size") >= least))
        ids = rows.select("doc_id", "sha", "digest")
        near = ids.join(hot, "digest").select(*outcome)
        rest = ids.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
        far = rest.join(single.where(F.col("group_size") < least), "digest").select(*outcome)
        if not several:
            return near.unionByName(far)
        held = self._read_all_entries().join(small(shared, HOT), "digest", "left_semi")
        told = held.join(classes, ["digest", "snapshot", "entry"]).select("digest", "packed", "keep_id", "group_size")
        doubtful = rows.join(small(shared, HOT), "digest", "left_semi").join(told, ["digest", "packed"])
        return near.unionByName(far).unionByName(doubtful.select(*outcome))

    def _read_all_entries(self) -> DataFrame:
        entries = [self._read(n, "entries").select("digest", "packed", "entry", F.lit(n).alias("snapshot")) for n in self._complete()]
        every = entries[0]
        for part in entries[1:]:
            every = every.unionByName(part)
        return every


def dedup(docs: DataFrame, batches: int = 2, digest_bytes: int = DIGEST_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    The rows arrive as ``batches`` batches, dealt by the hash of their id; every batch is ingested, and the outcome
    does not depend on their number.
    """
    spark = docs.sparkSession
    rows = written(digest(docs, digest_bytes), "dedup-rows")
    store = Snapshots(spark, work_folder(spark, "dedup-snapshots"), bucket_keys)
    turn = F.floor(share(F.col("doc_id"), 13) * batches)
    for number in range(batches):
        store.add(rows.where(turn == number))
    return store.judge(rows).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
