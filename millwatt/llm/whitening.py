"""Whitening of embeddings on the leading principal components, found by spectrum slicing.

Entries become whole numbers, so count, sums and the sums of products around a whole-number pivot next to the mean are
exact and do not depend on how rows are dealt to tasks. A task leaves one row for each pair of dimensions, merged by Spark; the
covariance, ``dims * dims`` numbers, comes to the driver, where :mod:`.spectrum` finds the components. Whitening is a map over the
vectors; its covariance is then measured from the values written.

Bounds: the driver and each task hold a few matrices of ``dims * dims`` numbers; nothing there grows with the rows.

Defined results: vectors that are null or hold a null or a non-finite entry are dropped; the dimension is that of most vectors
(the larger one in ties), and vectors of another length are dropped as well, empty ones always; a null id is a row like any other; equal rows come out as
they went in; a component of no variance (below ``1e-12`` of the trace) has ``whitened`` null and does not count for the identity
error; fewer than ``components`` dimensions give so many components; ``deviation`` beyond a long is null; a vector with an entry beyond
``2**36`` in size, for which sums would not fit, is dropped as if it were not finite; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from . import spectrum
from .stage import written

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
NO_VARIANCE = 1e-12
LARGEST = float(1 << 36)
_BLOCK = 4096


@dataclass
class Model:
    """Count, exact sums, components as columns with their eigenvalues, and the trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _entries(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that count, and their whole-number entries; without ``dims`` the lengths of rows whose entries all count."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(lengths.sum())) if len(column) else column.values
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    owner = np.repeat(np.arange(len(column)), lengths)
    bad = ~(np.abs(values) <= LARGEST)
    good = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool) & (lengths > 0)
    good[owner[bad]] = False
    if dims is None:
        return np.flatnonzero(good), lengths[good]
    good &= lengths == dims
    rows = np.flatnonzero(good)
    kept = values[good[owner]].reshape(len(rows), dims)
    return rows, np.floor(SCALE * kept).astype(np.int64) + OFFSET


def dimension(vectors: DataFrame) -> int | None:
    """The length of most vectors; None when there is none."""

    def run(batches):
        for batch in batches:
            lengths, n = np.unique(_entries(batch.column(0))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64()), pa.array(n, pa.int64())], names=["dims", "n"])

    counted = vectors.select("embedding").mapInArrow(run, "dims long, n long").groupBy("dims").agg(F.sum("n").alias("n"))
    most = counted.orderBy(F.desc("n"), F.desc("dims")).first()
    return most.dims if most else None


def _sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def run(batches):
        n, total = 0, [0] * dims
        for batch in batches:
            rows, x = _entries(batch.column(0), dims)
            n += len(rows)
            total = [t + s for t, s in zip(total, x.sum(0).tolist(), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * dims, pa.int64())], names=["i", "s", "n"]
            )

    made = vectors.select("embedding").mapInArrow(run, "i int, s string, n long")
    found = made.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    sums = [0] * dims
    for r in found:  # one row a dimension
        sums[r.i] = int(r.s)
    return (found[0].n if found else 0), sums


def _products(vectors: DataFrame, dims: int, pivot: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums of products of entries less ``pivot``, for each pair of dimensions ``i <= j``."""
    upper = np.triu_indices(dims)

    def run(batches):
        total, some = np.zeros(len(upper[0]), object), False
        for batch in batches:
            _, x = _entries(batch.column(0), dims)
            for at in range(0, len(x), _BLOCK):
                y = x[at : at + _BLOCK] - pivot
                some = True
                # Doubles multiply whole numbers exactly while sums stay below 2**53.
                if len(y) * float(np.abs(y).max()) ** 2 < 2.0**53:
                    made = (y.astype(float).T @ y.astype(float)).astype(np.int64)
                else:
                    wide = y.astype(object)
                    made = wide.T @ wide
                total = total + made[upper].astype(object)
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array([str(t) for t in total])], names=["i", "j", "p"]
            )

    made = vectors.select("embedding").mapInArrow(run, "i int, j int, p string")
    summed = made.groupBy("i", "j").agg(F.sum(F.col("p").cast("decimal(38,0)")).alias("p"))
    return {(r.i, r.j): int(r.p) for r in summed.collect()}  # dims * (dims + 1) / 2 rows


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Components of the covariance (divisor ``n``) of all vectors that count; None when there are none."""
    dims = dimension(vectors)
    if dims is None:
        return None
    n, sums = _sums(vectors, dims)
    pivot = np.array([s // n for s in sums], np.int64)
    products = _products(vectors, dims, pivot)
    # Products are around a pivot within one of the mean; the rest of the centring is exact in whole numbers, too.
    rest = [s - n * int(p) for s, p in zip(sums, pivot, strict=True)]
    covariance = np.zeros((dims, dims))
    for (i, j), p in products.items():
        covariance[i, j] = covariance[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
    values, found = spectrum.leading(covariance, components)
    return Model(n, np.array(sums, object), values, found, float(np.trace(covariance)))


def _overflow(x: np.ndarray, model: Model) -> list[int | None]:
    """Deviations by whole numbers of any size."""
    out = []
    for row in x.tolist():
        total = sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums, strict=True))
        out.append(total if total < 1 << 63 else None)
    return out


def transform(vectors: DataFrame, model: Model) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array, one value a component) of every vector that counts."""
    dims, n = len(model.sums), model.n
    useful = model.values > NO_VARIANCE * model.trace
    weights = model.vectors / np.sqrt(np.where(useful, model.values, 1.0))
    whole = [int(s) // n for s in model.sums]
    fraction = np.array([(int(s) - n * w) / n for s, w in zip(model.sums, whole, strict=True)])
    whole = np.array(whole, np.int64)
    k = len(model.values)

    def run(batches):
        for batch in batches:
            rows, x = _entries(batch.column("embedding"), dims)
            centred = (x - whole).astype(float) - fraction
            z = centred @ weights
            reach = float(np.abs(centred).max(initial=0.0) + 1) * n
            if dims * reach**2 < 2.0**62:
                off = n * (x - whole) - np.array([int(s) - n * int(w) for s, w in zip(model.sums, whole, strict=True)], np.int64)
                deviation = pa.array((off * off).sum(1), pa.int64())
            else:
                deviation = pa.array(_overflow(x, model), pa.int64())
            flat = pa.array(z.ravel(), mask=np.tile(~useful, len(rows)))
            lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * k, flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), deviation, lists], names=["vec_id", "deviation", "whitened"]
            )

    made = StructType([vectors.schema["vec_id"], StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
    return vectors.select("vec_id", "embedding").mapInArrow(run, made)


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the covariance (divisor ``n``) of the values written, less the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    # Spark's covariance centres as it goes.
    off = [F.abs(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) - F.lit(float(i == j))) for i, j in pairs]
    return whitened.agg(F.array_max(F.array(*off)).alias("e")).first().e if pairs else None


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector that counts and each component."""
    schema = StructType([vectors.schema["vec_id"]])
    model = fit(vectors, components)
    if model is None:
        none = vectors.sparkSession.createDataFrame([], schema)
        names = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
        return none.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in names.items()])
    made = written(transform(vectors, model), "whitening-values")
    error = identity_error(made, len(model.values))
    share = model.values / model.trace if model.trace > 0 else np.zeros(len(model.values))
    explained = F.array(*[F.lit(float(v)) for v in share])
    spread = made.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
