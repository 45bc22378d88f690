"""Importance resampling towards a target distribution of hashed word n-grams.

Words and pairs of neighbouring words (see :mod:`.ngrams`) fall into ``BUCKETS`` buckets by the crc32 of their bytes. A
bucket's gain is the floored 1000-fold log ratio of its smoothed share in the target texts and in the raw corpus; a
document weighs the floored mean of the gains of its n-grams, and the highest ``share`` per cent of weight plus Gumbel
noise, a number made from the seed and the id, are drawn: sampling without replacement in proportion to ``exp(weight / 1000)``.

Each batch interns its n-grams in an open-addressed table keyed by xxHash64 with byte verification; slots store bucket and count, so a
distinct n-gram is hashed to its bucket once a batch, and the slots of the occurrences gather the gains. Corpus counts leave a task as
at most ``BUCKETS`` rows and are at most so many in all; gains are a constant of the scoring map. The draw counts scores by
``BIN`` neighbouring values (few thousand rows, since scores are bounded by logarithms of counts), which gives the number of documents above each
bin, and ranks inside bins. A bin never holds more than ``BIN / (1000 e)`` of the ids, about 0.3 %, however alike the texts are, as the noise alone spreads them.

Defined results: a null or empty text, or one without words, has 0 features and weight 0; fewer than ``least_words`` words: scored
but never drawn; a null id takes its noise from an empty one and comes after other ids in ties; of rows alike in id and
score, each has a rank of its own; a text of any length is read whole, in pieces; without target texts the gains still follow
the formula; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .ngrams import Table, grams
from .stage import written

BUCKETS = 10_000
BIN = 8


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many n-grams of all texts (column ``text``) fall into each bucket that occurs."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in grams(batch.column(0)):
                table = Table(found, buckets)
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from two tables of :func:`bucket_counts`; at most ``buckets`` rows each."""
    s, t = [0] * buckets, [0] * buckets
    for counts, into in ((raw, s), (target, t)):
        for r in counts.collect():
            into[r.bucket] = r.n
    all_s, all_t = sum(s), sum(t)
    return [
        math.floor(1000 * math.log((float(t[b] + 1) * float(all_s + buckets)) / (float(s[b] + 1) * float(all_t + buckets))))
        for b in range(buckets)
    ]


def weigh(docs: DataFrame, gain: Sequence[int]) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""
    table_of = np.array(gain, np.int64)
    buckets = len(table_of)

    def run(batches):
        for batch in batches:
            words = np.zeros(batch.num_rows, np.int64)
            n, total = words.copy(), words.copy()
            for found in grams(batch.column("text")):
                table = Table(found, buckets)
                gathered = table_of[table.bucket][table.slot]
                here = slice(found.first, found.first + len(found.words))
                words[here] += found.words
                n[here] += np.bincount(found.owner, minlength=len(found.words))
                # Whole numbers far below 2**53, so sums in doubles are exact.
                total[here] += np.bincount(found.owner, gathered, len(found.words)).astype(np.int64)
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(n), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    kept = docs.schema["doc_id"]
    long = [StructField(name, LongType()) for name in ("n_words", "n_features", "weight")]
    return docs.select("doc_id", "text").mapInArrow(run, StructType([kept, *long]))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id in thousandths, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, share: int) -> DataFrame:
    """Add ``rank`` to the ``share`` per cent of the ``eligible`` rows with the highest ``score``; null for the others.

    ``scored`` is a written table: it is read twice.
    """
    able = scored.where("eligible")
    per_bin = able.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(F.count("*").alias("n"))
    higher = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = per_bin.select(
        "bin",
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"),
        F.floor(F.sum("n").over(Window.partitionBy()) * share / 100).alias("quota"),
    )
    reached = above.where("above < quota")
    inside = Window.partitionBy("bin").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    # A row for each bin that is reached; their number is bounded by the range of scores.
    binned = scored.withColumn("bin", F.when(F.col("eligible"), F.floor(F.col("score") / BIN)))
    candidates = binned.join(F.broadcast(reached), "bin")
    ranked = candidates.withColumn("place", F.col("above") + F.row_number().over(inside))
    others = binned.join(F.broadcast(reached.select("bin")), "bin", "left_anti")
    rank = F.when(F.col("place") <= F.col("quota"), F.col("place")).cast("long").alias("rank")
    none = F.lit(None).cast("long").alias("rank")
    return ranked.select(*scored.columns, rank).unionByName(others.select(*scored.columns, none))


def resample(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    ``target`` has a ``text`` column.
    """
    weighed = weigh(docs, gains(bucket_counts(docs), bucket_counts(target)))
    scored = weighed.select(
        "doc_id",
        "n_features",
        "weight",
        (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible"),
    )
    return draw(written(scored, "resampling-scores"), share).drop("eligible")
