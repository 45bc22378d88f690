"""What tells one run of a stream from another, and small state that goes from batch to batch.

State is a table of versions under ``out/state``, each named by the stream and batch that wrote it. A batch
that is run again starts from the version before its own; a stream with a new checkpoint goes on from the
newest one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from millwatt.sources.files import delete_folder, empty, exists, folders


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that Spark keeps in a checkpoint: the same after a restart, a new one with a new checkpoint.

    Batch numbers begin at 0 in every checkpoint, so only together with this id do they name a batch.
    """
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def versions(spark: SparkSession, out: str) -> dict[int, tuple[str, int, str]]:
    """Stored states that were written to their end: stream, batch and folder by version."""
    found = {}
    for folder in folders(spark, f"{out}/state/version=*/stream=*/batch_id=*"):
        version, stream, batch = (part.split("=", 1)[1] for part in folder.rstrip("/").split("/")[-3:])
        if exists(spark, f"{folder}/_SUCCESS"):
            found[int(version)] = (stream, int(batch), folder)
    return found


def before(spark: SparkSession, out: str, stream: str, batch_id: int, schema: str) -> tuple[int, DataFrame]:
    """Version this batch writes, and the state it starts from."""
    known = versions(spark, out)
    own = [v for v, (s, b, _) in known.items() if (s, b) == (stream, batch_id)]
    version = own[0] if own else max(known, default=-1) + 1
    if version - 1 not in known:
        return version, empty(spark, schema)
    return version, spark.read.schema(schema).parquet(known[version - 1][2])


def forget(spark: SparkSession, out: str, version: int) -> None:
    """Remove versions that no repeated batch can need once ``version`` is written."""
    for number, (_, _, folder) in versions(spark, out).items():
        if number < version - 1:
            delete_folder(spark, folder.rsplit("/", 2)[0])
