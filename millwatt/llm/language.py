"""Language identification with a string kernel.

A text is the set of hashed letter n-grams of one to three characters that it holds (blended spectrum, presence
only); the kernel of two texts is the size of the common set over the geometric mean of their sizes. A Nyström map over a
few landmark texts of each language makes the kernel linear, and one-versus-rest ridge regression is solved on it.
Scores of a batch are one product of its presence matrix with the landmarks and one with the weights.

Fitting takes a bounded sample: ``sample`` texts in all, spread over the ``languages`` most frequent languages (at least 20
each); rarer ones are not learned. Their presence sets, 1 KB each, come to the driver, where a system of the landmarks' number is solved; nothing else does. Scoring is
a map over the documents without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text when there was nothing
to learn from; null ids and equal rows come out as they went in; an empty table gives no rows; other columns are
not read by the scorer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .letters import Letters, letters
from .stage import share
from .words import mix

UNDETERMINED = "und"
SPACE = 1 << 13  # hashed n-grams
ORDERS = (1, 2, 3)
ROWS = 256  # texts in a batch of products


def presence(block: Letters) -> np.ndarray:
    """A row for each text: 1 where it holds an n-gram of that hash. All else than letters is one separator."""
    out = np.zeros((len(block), SPACE), np.float32)
    t = np.where(block.letter, block.points, 0).astype(np.uint64)
    owner = block.owner()
    for n in ORDERS:
        m = len(t) - n + 1
        if m <= 0:
            continue
        code, filled = t[:m].copy(), block.letter[:m].copy()
        for k in range(1, n):
            code = code * np.uint64(0x110001) + t[k : k + m]
            filled |= block.letter[k : k + m]
        use = filled & (owner[:m] == owner[n - 1 :])
        column = mix(code[use] + np.uint64(n << 60)) & np.uint64(SPACE - 1)
        out[owner[:m][use], column.astype(np.int64)] = 1
    return out


def kernel(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(x.sum(1), 1)[:, None] * np.maximum(z.sum(1), 1)[None, :])
    return (x @ z.T) / norm


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed bits
    weights: np.ndarray


def learnable(doc_id: Column) -> Column:
    """Rows a model may learn from: the remainder of the id's checksum is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _bits(batches):
    for batch in batches:
        texts, langs = batch.column("text"), batch.column("lang")
        for block in letters(texts, most=ROWS):
            packed = np.packbits(presence(block).astype(bool), axis=1)
            yield pa.RecordBatch.from_arrays(
                [langs.slice(block.first, len(block)).cast(pa.string()), pa.array([r.tobytes() for r in packed], pa.binary())],
                names=["lang", "bits"],
            )


def fit(docs: DataFrame, sample: int = 4000, landmarks: int = 128, ridge: float = 1e-3, languages: int = 128) -> Model:
    """Learn from ``doc_id, text, lang`` rows whose id may be learned from and whose lang is known.

    The ``languages`` most frequent languages are learned (ties by name), with at most ``landmarks`` landmarks, one each at least,
    and about ``sample`` rows, 20 of each language at least. Rows alike in id and text are drawn once.
    """
    languages = min(languages, landmarks)
    known = docs.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Copies of a row do not count, as they are drawn once; the sketch does not depend on the order of rows.
    counts = known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("doc_id", "text")).alias("count"))
    counts = counts.orderBy(F.col("count").desc(), "lang").limit(languages)
    n = min(languages, counts.count())
    each = max(20, sample // max(n, 1))
    # One row for each language; about ``each`` rows of it are drawn by the hash of id and text.
    quota = counts.select(F.col("lang").alias("quota_lang"), (F.lit(float(each)) / F.col("count")).alias("quota"))
    drawn = known.join(F.broadcast(quota), F.col("lang") == F.col("quota_lang")).where(share(F.xxhash64("doc_id", "text"), 8) < F.col("quota"))
    drawn = drawn.groupBy("doc_id", F.xxhash64("text").alias("h"), "lang").agg(F.first("text").alias("text"))
    rows = drawn.select("text", "lang").mapInArrow(_bits, "lang string, bits binary").collect()
    rows = sorted((r.lang, bytes(r.bits)) for r in rows)
    names = sorted({lang for lang, _ in rows})
    if not rows:
        return Model([], np.zeros((0, SPACE // 8), np.uint8), np.zeros((0, 0), np.float32))
    packed = np.stack([np.frombuffer(b, np.uint8) for _, b in rows])
    target = np.array([names.index(lang) for lang, _ in rows])
    per = max(1, landmarks // len(names))
    # Rows lie in order of their bits, which is no order of meaning: take them at even steps.
    chosen = []
    for k in range(len(names)):
        own = np.flatnonzero(target == k)
        chosen.append(own[np.linspace(0, len(own) - 1, min(per, len(own))).astype(int)])
    chosen = np.concatenate(chosen)
    unpack = lambda p: np.unpackbits(p, axis=1).astype(np.float32)
    z = unpack(packed[chosen])
    k = np.concatenate([kernel(unpack(packed[i : i + ROWS]), z) for i in range(0, len(packed), ROWS)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel(z, z).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # Nyström: kernel with landmarks times this is the feature map
    phi = np.hstack([k @ root, np.ones((len(k), 1))])
    y = np.where(target[:, None] == np.arange(len(names)), 1.0, 0.0)
    solved = np.linalg.solve(phi.T @ phi + ridge * len(phi) * np.eye(phi.shape[1]), phi.T @ y)
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    return Model(names, packed[chosen], weights.astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs``, then ``lang_pred`` and ``score`` (columns of these names are replaced)."""
    docs = docs.drop("lang_pred", "score")

    def score(batches):
        z = np.unpackbits(model.landmarks, axis=1).astype(np.float32)
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            best = np.full(batch.num_rows, len(names) - 1)
            sure = np.zeros(batch.num_rows)
            for block in letters(batch.column("text"), most=ROWS):
                here = slice(block.first, block.first + len(block))
                lettered = np.bincount(block.owner()[block.letter], minlength=len(block)) > 0
                if model.languages:
                    x = kernel(presence(block), z)
                    f = x @ model.weights[:-1] + model.weights[-1]
                    p = np.exp(8 * (f - f.max(1, keepdims=True)))
                    p /= p.sum(1, keepdims=True)
                    best[here] = np.where(lettered, f.argmax(1), len(names) - 1)
                    sure[here] = np.where(lettered, p.max(1), 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(sure.astype(float))],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    more = StructType.fromDDL("lang_pred string, score double")
    return docs.mapInArrow(score, StructType([*docs.schema.fields, *more.fields]))
