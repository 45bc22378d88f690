"""Texts compressed in tasks, for moving them to other tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

_CODEC = "zstd"


def pack(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` as they are and ``packed``, the compressed ``text``; null counts as empty."""

    def run(batches):
        codec = pa.Codec(_CODEC)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            packed = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(packed, pa.binary())], names=[*keys, "packed"])

    kept = [docs.schema[k] for k in keys]
    return docs.select(*keys, "text").mapInArrow(run, StructType([*kept, StructField("packed", BinaryType())]))


def unpack(packed: pa.Array) -> pa.Array:
    """The texts of a column that :func:`pack` made."""
    codec = pa.Codec(_CODEC)
    texts = [codec.decompress(p[8:], int.from_bytes(p[:8], "little"), asbytes=True) for p in packed.to_pylist()]
    return pa.array(texts, pa.binary()).cast(pa.string())
