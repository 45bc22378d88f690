"""Near-duplicate documents by min-max hashing.

A document is its set of distinct word shingles. Under each hash function both the least and the greatest value are kept,
so ``FUNCTIONS`` evaluations give twice as many signature values. Both are unbiased: either agrees between two sets
with the probability of their Jaccard similarity. Four values from four functions make a band; two documents that share
a band are candidates. At similarity 0.75 all 48 bands differ with probability 1e-8.

Documents with equal sets are one class and go on as its smallest id. In each band bucket every class is compared with
the smallest one of the bucket, exactly, on full sets. Links give components. Where a bucket still holds several
components, its classes are dealt to blocks of bounded size and blocks are laid side by side: whole signatures (one byte
a value) are compared across components inside the task, and pairs whose estimate comes within four standard errors of
the threshold are compared exactly there as well; only links come out. So a large group of near copies costs a link for each
member and not for each pair, and documents that merely share a passage are told apart by their signatures without a row for each pair.

Defined results: words are lower-cased in A-Z and split at ``[\\x20\\x09-\\x0D]+``; a text with fewer words than a shingle is
one shingle; a null, empty or blank text has none, is linked with nothing and stays; rows with one id are one document
for links, and each comes out; a null id is linked with nothing, has no component and stays; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .packing import pack, unpack
from .stage import written
from .words import Words, mix, rolling, tokenise

SHINGLE = 5
PERCENT = 75
FUNCTIONS = 128
BAND = 4
BANDS = 48  # of the first 96 functions
BLOCK = 512  # classes of a bucket that are laid beside others at a time
SLACK = 0.11  # four standard errors of an estimate from 256 values at similarity 0.75
_random = np.random.default_rng(20)
_MULTIPLIERS = _random.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)


def shingle_sets(tokens: Words, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text of a chunk, one after the other, and their bounds."""
    owner = tokens.owner()
    n = len(owner) - shingle + 1
    sizes = np.diff(tokens.bounds)
    texts, values = [], []
    if n > 0:
        inside = np.flatnonzero(owner[:n] == owner[shingle - 1 :])
        texts.append(owner[inside])
        values.append(rolling(tokens.hashes, shingle)[inside])
    for length in range(1, shingle):  # the whole of a shorter text
        own = np.flatnonzero(sizes == length)
        if len(own):
            texts.append(own)
            values.append(mix(rolling(tokens.hashes, length)[tokens.bounds[own]] + np.uint64(length)))
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(len(tokens) + 1, np.int64)
    text, value = np.concatenate(texts), np.concatenate(values)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, value = text[new], value[new]
    return value, np.searchsorted(text, np.arange(len(tokens) + 1))


def _digests(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set; 0 for an empty one."""
    total = np.zeros((2, len(sets) + 1), np.uint64)
    for k, salt in enumerate((0x1234567, 0x7654321)):
        np.cumsum(mix(sets ^ np.uint64(salt)), out=total[k, 1:])
    one, two = total[:, bounds[1:]] - total[:, bounds[:-1]]
    return mix(one + np.diff(bounds).astype(np.uint64)).view(np.int64), mix(two).view(np.int64)


def _signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Least and greatest values, a row for each set that is not empty."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((2, FUNCTIONS, len(starts)), np.uint64)
    for k in range(FUNCTIONS):
        v = sets * _MULTIPLIERS[k] + _OFFSETS[k]
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        out[0, k] = np.minimum.reduceat(v, starts)
        out[1, k] = np.maximum.reduceat(v, starts)
    return out


def _bands(values: np.ndarray) -> np.ndarray:
    """Band hashes; a band takes its values from ``BAND`` functions."""
    half = BANDS // 2
    out = np.empty((BANDS, values.shape[2]), np.uint64)
    for side in (0, 1):
        for band in range(half):
            key = np.full(values.shape[2], side * half + band + 1, np.uint64)
            for r in range(BAND):
                key = mix(key ^ values[side, band * BAND + r])
            out[side * half + band] = key
    return out.T.view(np.int64)


def _bytes(values: np.ndarray) -> np.ndarray:
    """A byte of each value."""
    return np.ascontiguousarray((mix(values.reshape(2 * FUNCTIONS, -1)) >> np.uint64(56)).astype(np.uint8).T)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands, values``: size, digest of the set (its class), band hashes, a byte of each value."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for tokens in tokenise(batch.column("text"), lower=True):
                sets, bounds = shingle_sets(tokens)
                sizes = np.diff(bounds)
                d1, d2 = _digests(sets, bounds)
                values = _signatures(sets, bounds) if len(sets) else np.zeros((2, FUNCTIONS, 0), np.uint64)
                rows, short = _bands(values), _bytes(values)
                some = iter(short)
                sketches = pa.array([next(some).tobytes() if n else None for n in sizes], pa.binary())
                lists = pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum((sizes > 0) * BANDS)]).astype(np.int32), pa.array(rows.ravel())
                )
                ids = batch.column("doc_id").slice(tokens.first, len(tokens))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes.astype(np.int64)), pa.array(d1), pa.array(d2), lists, sketches],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands", "values"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, d1 long, d2 long, bands array<long>, values binary"
    )


def _sets_of(packed: pa.Array, d1: list[int], d2: list[int]) -> Iterator[np.ndarray | None]:
    """The set of each packed text; None where it is not the set of that digest."""
    for tokens in tokenise(unpack(packed), lower=True):
        sets, bounds = shingle_sets(tokens)
        one, two = _digests(sets, bounds)
        for k in range(len(tokens)):
            i = tokens.first + k
            yield sets[bounds[k] : bounds[k + 1]] if (one[k], two[k]) == (d1[i], d2[i]) else None


def _near(x: np.ndarray | None, y: np.ndarray | None, percent: int) -> bool:
    both = 0 if x is None or y is None else len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _compare(percent: int):
    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(name).to_pylist()  # noqa: E731, B023
            left = _sets_of(batch.column("pa"), column("a1"), column("a2"))
            right = _sets_of(batch.column("pb"), column("b1"), column("b2"))
            keep = pa.array([_near(x, y, percent) for x, y in zip(left, right, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, packed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The links among ``pairs`` (``a, a1, a2, b, b1, b2``: ids and digests), on full sets.

    The texts of ``b``, few and often the same, are fetched first and meet the pairs; then each ``a`` meets its pairs.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    with_b = pairs.join(packed.select(F.col("doc_id").alias("b"), F.col("packed").alias("pb")), "b")
    with_a = with_b.join(packed.select(F.col("doc_id").alias("a"), F.col("packed").alias("pa")), "a")
    return with_a.mapInArrow(_compare(percent), f"a {kind}, b {kind}")


def _widened(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Give pairs of class ids the digests of their classes."""
    ends = [classes.select(F.col("rep").alias(x), F.col("d1").alias(f"{x}1"), F.col("d2").alias(f"{x}2")) for x in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys, from sorted batches. A group has two blocks at most."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([*rest, batch]).combine_chunks()
        columns = [whole.column(k).to_numpy() for k in keys]
        change = np.zeros(whole.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield whole.slice(a, b - a)
        rest = whole.slice(cuts[-1]).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def _across(percent: int):
    """Links between components in a group of two blocks, each in the first band that its two classes share.

    Whole signatures are compared first; sets are unpacked and compared where they come near the threshold.
    """
    least = percent / 100 - SLACK
    needed = int(np.ceil(2 * FUNCTIONS * (least + (1 - least) / 256)))

    def run(batches):
        for group in _groups(batches, ["band", "value", "i", "j"]):
            component = group.column("component").to_numpy()
            if (component == component[0]).all():
                continue
            rep, block = group.column("rep").to_numpy(), group.column("block").to_numpy()
            i, j, band = (group.column(x)[0].as_py() for x in ("i", "j", "band"))
            values = np.frombuffer(b"".join(group.column("values").to_pylist()), np.uint8).reshape(len(rep), -1)
            bands = np.array(group.column("bands").to_pylist(), np.int64)
            pairs = []
            for x in np.flatnonzero(block == i).tolist():
                other = np.flatnonzero((component != component[x]) & (block == j) & ((rep > rep[x]) | (i != j)))
                near = other[(values[other] == values[x]).sum(1) >= needed]
                near = near[(bands[near, :band] != bands[x, :band]).all(1)]
                pairs += [(x, y) for y in near.tolist()]
            if not pairs:
                continue
            used = np.unique(np.array(pairs))
            rows = group.take(pa.array(used)).combine_chunks()
            packed = rows.column("packed").chunk(0)
            unpacked = _sets_of(packed, rows.column("d1").to_pylist(), rows.column("d2").to_pylist())
            sets = dict(zip(used.tolist(), unpacked, strict=True))
            found = [(x, y) for x, y in pairs if _near(sets[x], sets[y], percent)]
            if found:
                a, b = rep[np.array(found)].T
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    return run


def across(members: DataFrame, classes: DataFrame, found: DataFrame, packed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between components of ``found`` within the buckets of ``members`` (``band, value, rep``), confirmed on full sets."""
    bucket = ["band", "value"]
    placed = members.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        *bucket, "rep", F.coalesce("component", "rep").alias("component")
    )
    sizes = (
        placed.groupBy(*bucket)
        .agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select(*bucket, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    open_rows = written(placed.join(sizes, bucket), "minhash-open")
    # An id with several texts has a row for each; the one of the class is told by its digest.
    texts = packed.select(F.col("doc_id").alias("rep"), "packed")
    laid = (
        open_rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .join(classes.select("rep", "d1", "d2", "bands", "values"), "rep")
        .join(texts, "rep")
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "with"))
        .withColumn("j", F.greatest("block", "with"))
        .drop("with", "blocks")
    )
    kind = members.schema["rep"].dataType.simpleString()
    key = [*bucket, "i", "j"]
    return laid.repartition(*key).sortWithinPartitions(*key).mapInArrow(_across(percent), f"a {kind}, b {kind}")


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    signed = written(signatures(docs), "minhash-signatures")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    classes = written(
        filled.groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("values").alias("values")),
        "minhash-classes",
    )
    members = classes.select("rep", F.posexplode("bands").alias("band", "value"))
    buckets = members.groupBy("band", "value").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
    shared = written(buckets.where("leader <> last").drop("last"), "minhash-buckets")
    in_buckets = written(members.join(shared, ["band", "value"]).select("band", "value", "rep", "leader"), "minhash-members")
    packed = pack(docs, ["doc_id"])
    pairs = in_buckets.where("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    links = written(confirmed(_widened(pairs, classes), packed, percent), "minhash-links")
    found = written(components(links), "minhash-components")
    links = links.unionByName(written(across(in_buckets, classes, found, packed, percent).distinct(), "minhash-links"))
    # An id that stands for several sets connects them.
    same_id = filled.groupBy("doc_id").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).where("x <> y")
    reps = signed.join(same_id.select("doc_id"), "doc_id", "left_semi").join(classes.select("d1", "d2", "rep"), ["d1", "d2"])
    links = links.unionByName(reps.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = components(links)
    labelled = (
        signed.drop("bands", "values")
        .join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left")
        .withColumn("rep", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")))
        .join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")))
    )
    return labelled.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
