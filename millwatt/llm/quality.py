"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Features of a text are its words and pairs of words, and runs of one to three word shapes (upper case, lower case,
digits, other signs as they are; marked when a word repeats the one before), hashed to 2**18 columns, valued
``log(1 + count)`` and scaled to unit length. Scores are sparse dot products.

Training takes a bounded sample of labelled rows (ids by ``sample``, at most twice as many different texts). It is dealt to ``SHARDS`` groups by hash; each
group, at most a few thousand texts, runs FTRL-proximal over its rows and Spark averages the weights, at most 2**18 rows, which come to the driver and
go to the scorers. Scoring is a map over the documents without a shuffle.

Defined results: a null or empty text has no features and scores as the intercept says; without any label of both
kinds every score is 0.5; null ids are not held out and not learned from; equal rows come out as they went in;
conflicting labels of one id count as 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import sampled, share, written
from .words import Words, mix, rolling, tokenise, windows

SPACE = 1 << 18
SHARDS = 8
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")  # parts of letters outside ASCII, mostly
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def shapes(tokens: Words) -> np.ndarray:
    """Hash of each word's shape: its classes of signs in order, equal neighbours once."""
    n = len(tokens.starts)
    if not n:
        return np.zeros(0, np.uint64)
    lead = tokens.starts[0]
    kind = _CLASS[tokens.data[lead:]]
    starts, ends = tokens.starts - lead, tokens.ends - lead
    lengths = np.diff(starts, append=len(kind))
    inside = np.arange(len(kind)) < np.repeat(ends, lengths)
    fresh = inside.copy()
    fresh[1:] &= kind[1:] != kind[:-1]
    fresh[starts] = True
    count = np.cumsum(fresh)
    rank = count - np.repeat(count[starts], lengths)
    placed = kind.astype(np.uint64) + (np.minimum(rank, 15).astype(np.uint64) << np.uint64(8)) + np.uint64(1 << 20)
    terms = np.where(fresh, mix(placed), np.uint64(0))
    return mix(np.add.reduceat(terms, starts))


def features(tokens: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, column and value of every feature of a chunk, by text."""
    shape = shapes(tokens)
    again = np.zeros(len(shape), bool)
    if len(shape) > 1:
        again[1:] = tokens.hashes[1:] == tokens.hashes[:-1]
        again[tokens.bounds[:-1][tokens.bounds[:-1] < len(shape)]] = False
    shape = shape ^ (again.astype(np.uint64) * np.uint64(0x5851F42D4C957F2D))
    texts, codes = [], []
    for salt, (source, n) in enumerate([(tokens.hashes, 1), (tokens.hashes, 2), (shape, 1), (shape, 2), (shape, 3)]):
        inside, owner = windows(tokens, n)
        texts.append(owner)
        codes.append(mix(rolling(source, n)[inside] + np.uint64(salt)) & np.uint64(SPACE - 1))
    keys, counts = np.unique(
        np.concatenate(texts).astype(np.uint64) * np.uint64(SPACE) + np.concatenate(codes), return_counts=True
    )
    text, column = (keys // np.uint64(SPACE)).astype(np.int64), (keys % np.uint64(SPACE)).astype(np.int64)
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(text, value * value, len(tokens)))
    return text, column, value / norm[text]


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last column is the intercept."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        dense = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, dense)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def labelled(docs: DataFrame, labels: DataFrame, target: str, sample: int, seed: int) -> DataFrame:
    """``text, y`` of about ``sample`` labelled documents at most that may be learned from."""
    known = (
        labels.where(learnable(F.col("doc_id")) & F.col(target).isNotNull())
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.max(F.col(target).cast("int")).alias("y"))
    )
    drawn = F.broadcast(sampled(known, "labelled_id", sample, seed))  # bounded by ``sample``
    return docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "text", "y")


def bounded(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """Rows of :func:`labelled`, those alike in id and text once; of more than ``most`` about so many, drawn by hash.

    Copies are merged in each task before they are shuffled.
    """
    once = rows.groupBy("doc_id", F.xxhash64("text").alias("h"), "y").agg(F.first("text").alias("text"))
    once = written(once, "quality-sample")
    n = once.count()
    few = once if n <= most else once.where(share(F.xxhash64("doc_id", "h"), seed) < most / n)
    return few.select("doc_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = 20_000, epochs: int = 3) -> np.ndarray:
    """The averaged weights: ``SPACE`` columns and the intercept."""

    def train(shard: pa.Table) -> pa.Table:
        model, rows, y = Ftrl(SPACE), [], shard.column("y").to_pylist()
        for tokens in tokenise(shard.column("text")):
            text, column, value = features(tokens)
            cut = np.searchsorted(text, np.arange(len(tokens) + 1))
            column, value = column.astype(np.int32), value.astype(np.float32)
            for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                rows.append((column[a:b].copy(), value[a:b].copy(), y[tokens.first + k]))
        # The order of a shard's rows must not depend on how they arrived.
        rows.sort(key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes(), r[2]))
        order = np.random.default_rng(0)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                model.learn(*rows[i])
        weights = model.weights()
        some = np.flatnonzero(weights)
        # The last row counts the shard itself.
        return pa.table({"at": np.append(some, -1), "weight": np.append(weights[some], 1.0)})

    rows = bounded(labelled(docs, labels, target, sample, 7), 2 * sample, 7)
    shard = F.pmod(F.xxhash64("doc_id", "text", F.lit(77)), F.lit(SHARDS)).alias("shard")
    trained = rows.select(shard, "text", "y").groupBy("shard").applyInArrow(train, "at long, weight double")
    found = {r.at: r.weight for r in trained.groupBy("at").agg(F.sum("weight").alias("weight")).collect()}  # SPACE + 2 rows
    shards = found.pop(-1, 1.0)
    weights = np.zeros(SPACE + 1)
    for at, weight in found.items():
        weights[at] = weight / shards
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` in 0 to 1 of every document."""
    packed = weights.astype(np.float32)

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for tokens in tokenise(batch.column("text"), lower=False):
                text, column, value = features(tokens)
                margin = np.bincount(text, packed[column] * value, len(tokens)) + packed[-1]
                out[tokens.first : tokens.first + len(tokens)] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
