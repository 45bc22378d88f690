"""Telemetry readers (topics and files, streaming and batch), landing and upkeep of the raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt import constants as C
from millwatt import schemas
from millwatt.sources.files import delete_folder, exists, folders
from millwatt.sources.rawtable import COLUMNS, SETTLED, RawTable

# A registry-framed message starts with a marker byte and a four-byte schema id.
FRAME_BYTES = 5


def read_topics(
    spark: SparkSession,
    servers: str,
    pattern: str = C.TELEMETRY_TOPIC_PATTERN,
    starting: str = "earliest",
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Stream of the telemetry topics; needs the Kafka connector on the class path.

    A topic that lost messages before they were read stops the stream unless told otherwise.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


# Where a message came from, kept beside its columns as far as the source has it.
ORIGIN = ("topic", "partition", "offset")


def _origin(messages: DataFrame, value: str) -> list[Column]:
    """The message as it came and its place, so that one set aside can be replayed."""
    return [F.col(value).alias("message"), *[F.col(name) for name in ORIGIN if name in messages.columns]]


def decode_avro(messages: DataFrame, value: str = "value") -> DataFrame:
    """Registry-framed Avro messages to event columns; broken ones come back with null columns.

    The message itself and its topic, partition and offset come along.
    """
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring({value}, {FRAME_BYTES + 1})")
    event = from_avro(body, schemas.TELEMETRY_AVRO, {"mode": "PERMISSIVE"})
    origin = _origin(messages, value)
    return messages.select(*origin, event.alias("e")).select(
        "message",
        *[name for name in ORIGIN if name in messages.columns],
        "e.deviceId",
        "e.source",
        "e.equipmentType",
        "e.building",
        F.unix_millis("e.ts_utc").alias("ts_utc"),
        "e.value",
        "e.metadata",
    )


def decode_json(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to event columns with text members; a broken message becomes null columns.

    The message itself and its topic, partition and offset come along.
    """
    event = F.from_json(F.col(value).cast("string"), schemas.TELEMETRY_TEXT_EVENT)
    origin = _origin(messages, value)
    placed = [name for name in ORIGIN if name in messages.columns]
    return messages.select(*origin, event.alias("e")).select("message", *placed, "e.*")


def read_event_files(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "parquet") -> DataFrame:
    """Event records kept in files, as a batch or as a stream of arriving files."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schemas.TELEMETRY_EVENT).format(fmt).load(path)


def by_device(raw: DataFrame, files: int | None = None) -> DataFrame:
    """Rows cut into even ranges of day, device and time, each sorted by device, newest first.

    Ranges follow the data, so a busy day or device is split over several tasks, and every file
    covers few devices, which lets its statistics prune. Rows alike in all three, such as copies of
    one message, are told apart by the input partition they come from.
    """
    placed = raw.withColumn("_from", F.spark_partition_id())
    columns = ["date", "device_id", "time", "_from"]
    ranged = placed.repartitionByRange(files, *columns) if files else placed.repartitionByRange(*columns)
    return ranged.sortWithinPartitions("date", "device_id", F.col("time").desc()).drop("_from")


def write_raw(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Write raw rows into day folders, clustered by device and newest first."""
    by_device(raw).write.mode(mode).partitionBy("date").option("compression", "zstd").parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows of a folder, whether days lie in it or in the batch folders of the landing stream, compacted or not."""
    if exists(spark, f"{path}/{SETTLED}"):
        return RawTable(spark, path).read()
    return spark.read.schema(schemas.RAW_TELEMETRY).parquet(path).select(*COLUMNS)


def compact_days(spark: SparkSession, path: str, target: str, before: str, files: int) -> None:
    """Write the table anew at ``target``, with the days before ``before`` in about ``files`` sorted files.

    Later days are copied as they are, so readers can move to ``target`` once the job has ended; the old folder
    is only read. Nothing may be appended to it meanwhile.
    """
    raw = read_raw(spark, path)
    limit = F.lit(before).cast("date")
    old = by_device(raw.where(F.col("date") < limit), files)
    old.write.mode("overwrite").partitionBy("date").option("compression", "zstd").parquet(target)
    write_raw(raw.where(F.col("date") >= limit), target)


def drop_days(spark: SparkSession, path: str, before: str) -> list[str]:
    """Delete the day folders of a raw table that are older than ``before``; returns their days.

    Days lie in the folder itself or in the stream and batch folders of the landing stream.
    """
    root = path.rstrip("/")
    if exists(spark, f"{root}/{SETTLED}"):
        return [f"date={day}" for day in RawTable(spark, root).retire(before)]
    dropped = set()
    for pattern in ("date=*", "batch_id=*/date=*", "stream=*/batch_id=*/date=*"):
        for folder in folders(spark, f"{root}/{pattern}"):
            day = folder.rstrip("/").rsplit("=", 1)[1]
            if day < before:
                delete_folder(spark, folder)
                dropped.add(f"date={day}")
    return sorted(dropped)


def retained(raw: DataFrame, oldest: Column) -> DataFrame:
    """Rows of days from ``oldest`` on; the predicate is on the partition column."""
    return raw.where(F.col("date") >= oldest)
