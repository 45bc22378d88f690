"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits, lower-cased. A seed is the hash of the tokens that a fixed mask keeps in a stretch of
text; tokens it skips may differ. Seeds of the benchmark items are joined with those of the documents. Around each hit
the two texts are laid side by side on the hit's diagonal, and an overlap counts when ``WINDOW`` consecutive tokens with the
hit in them have at most ``SUBSTITUTED`` that differ. The masks keep five or six tokens of five to seven. Together they
leave no gap: wherever the allowed differing tokens lie in a window, or in a shorter item, some mask misses them all
(the tests enumerate this for every length).

Native DataFrame functions only. Every mask keeps the first two tokens of its stretch. A fixed bitmap of the benchmark's token pairs
(2**18 bits) spares the places whose pair no seed starts with; only the rest are hashed and joined, each
with the 64-bit hashes of its neighbourhood, so hits are verified where they are found and no text is moved. The benchmark's
seeds are broadcast when counted to be at most ``BROADCAST_ROWS``, else Spark shuffles both sides.

Defined results: a null or empty text has no hits; an item with fewer tokens than the shortest mask cannot be found, a null or
empty one neither; items with fewer tokens than a window are compared as a whole; a null document id is reported like any
other, a null item id as null; equal rows come out as often as they went in; an empty benchmark contaminates
nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import written

MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 4, 5, 6))
SHORTEST = min(m[-1] for m in MASKS) + 1
LONGEST = max(m[-1] for m in MASKS) + 1
WINDOW = 13
SUBSTITUTED = 2
REACH = WINDOW - SHORTEST  # tokens of a window before or after a hit, at most
BITS = 1 << 18
BROADCAST_ROWS = 500_000


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _pair(h: Column, after: Column) -> Column:
    """Bit of two neighbouring tokens, from their hashes."""
    return F.pmod(h.bitwiseXOR(F.call_function("shiftright", after, F.lit(7))), F.lit(BITS))


def _around(hashes: Column, at: Column, salt: int) -> Column:
    """The hashes from ``REACH`` before a place to ``REACH`` after the longest mask; ``salt`` beyond the text."""
    return F.transform(
        F.sequence(at - REACH, at + (LONGEST + REACH - 1)),
        lambda k: F.when(k >= 0, F.coalesce(F.get(hashes, k), F.lit(salt))).otherwise(F.lit(salt)),
    )


def _seeds(around: str) -> Column:
    """``mask, seed`` for each mask that fits at the place in the middle of ``around``."""
    out = []
    for number, mask in enumerate(MASKS):
        kept = [F.get(F.col(around), F.lit(REACH + k)) for k in mask]
        out.append(F.struct(F.lit(number).alias("mask"), F.xxhash64(F.lit(number), *kept).alias("seed")))
    return F.array(*out)


_END = {"doc": -1, "item": -2}  # stand for tokens beyond the text


def bitmap(places: DataFrame) -> list[int]:
    """The pairs that start a seed, as masks of 32 bits: ``BITS`` bits whatever the size of the benchmark."""
    bits = places.select(_pair(F.get("hashes", "at"), F.get("hashes", F.col("at") + 1)).alias("bit"))
    masks = bits.groupBy(F.expr("cast(shiftright(bit, 5) as int)").alias("k")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("m")
    )
    out = [0] * (BITS // 32)
    for r in masks.collect():  # at most BITS / 32 rows
        out[r.k] = r.m
    return out


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, digest, item_id, shift`` of every verified overlap.

    ``shift`` is the place in the document less the place in the item.
    """
    long_enough = benchmark.select("item_id", tokens(F.col("text")).alias("hashes")).where(F.size("hashes") >= SHORTEST)
    items = written(long_enough, "benchmark")
    places = items.select("item_id", "hashes", F.explode(F.sequence(F.lit(0), F.size("hashes") - SHORTEST)).alias("at"))
    beside = _around(F.col("hashes"), F.col("at"), _END["item"])
    starts = written(
        places.select("item_id", F.size("hashes").alias("length"), "at", beside.alias("item"))
        .withColumn("s", F.explode(_seeds("item")))
        .select("item_id", "length", F.col("at").alias("item_at"), "item", "s.*")
        # A mask that leaves the item would hash what stands for its end.
        .where(F.element_at(F.array(*[F.lit(m[-1]) for m in MASKS]), F.col("mask") + 1) + F.col("item_at") < F.col("length")),
        "benchmark-seeds",
    )
    known = F.split(F.lit(",".join(map(str, bitmap(places)))), ",").cast("array<long>")
    count = starts.count()
    hashed = docs.select("doc_id", _digest(F.col("text")).alias("digest"), tokens(F.col("text")).alias("hashes"))

    def likely(h: Column, i: Column) -> Column:
        bit = _pair(h, F.get(F.col("hashes"), i + 1))
        held = F.get(known, F.call_function("shiftright", bit, F.lit(5)).cast("int"))
        return F.when(F.call_function("shiftright", held, bit.bitwiseAND(F.lit(31)).cast("int")).bitwiseAND(F.lit(1)) == 1, i)

    # No filter on ``at``: it would be pushed below ``hashes`` and compute them for every token again.
    found = hashed.withColumn(
        "at", F.array_compact(F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - (SHORTEST - 1), F.lit(0))), likely))
    )
    place = lambda k: F.struct(k.alias("at"), _around(F.col("hashes"), k, _END["doc"]).alias("doc"))
    near = found.select("doc_id", "digest", F.explode(F.transform("at", place)).alias("p"))
    each = near.select("doc_id", "digest", "p.at", "p.doc").withColumn("s", F.explode(_seeds("doc")))
    seeded = each.select("doc_id", "digest", "at", "doc", "s.*")
    met = seeded.join(F.broadcast(starts) if count <= BROADCAST_ROWS else starts, ["mask", "seed"])
    return (
        met.withColumn("same", F.zip_with("doc", "item", lambda x, y: (x == y).cast("int")))
        .where(_overlaps())
        .select("doc_id", "digest", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )


def _overlaps() -> Column:
    """Some window with the hit in it has few differing tokens; windows stay inside the item."""
    size = F.least(F.col("length"), F.lit(WINDOW))
    first = F.greatest(F.col("item_at") + SHORTEST - size, F.lit(0))
    last = F.least(F.col("item_at"), F.col("length") - size)
    starts = F.sequence(F.least(first, last), last)
    allowed = F.when(F.col("length") >= WINDOW, F.lit(SUBSTITUTED)).otherwise(F.floor(F.col("length") * SUBSTITUTED / WINDOW))
    agree = lambda s: F.aggregate(
        F.slice("same", (s - F.col("item_at") + REACH + 1).cast("int"), size), F.lit(0), lambda a, x: a + x
    )
    return F.exists(starts, lambda s: agree(s) >= size - allowed)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, items`` for every document; ``items`` are the ids of its benchmark items, in order."""
    no_item = F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id")
    rows = docs.select("doc_id", _digest(F.col("text")).alias("digest"), F.lit(1).alias("one"), no_item)
    leaks = hits(docs.select("doc_id", "text"), benchmark).select("doc_id", "digest", F.lit(0).alias("one"), "item_id").distinct()
    each = rows.unionByName(leaks).groupBy("doc_id", "digest").agg(
        F.sum("one").alias("times"), F.sum(1 - F.col("one")).alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    return each.select(
        "doc_id",
        (F.col("n_items") > 0).alias("contaminated"),
        F.col("n_items").cast("long").alias("n_items"),
        "items",
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    ).drop("copy")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark overlap, all columns as they were."""
    leaks = hits(docs.select("doc_id", "text"), benchmark).select(
        F.col("doc_id").alias("leak_id"), F.col("digest").alias("leak_digest")
    )
    same = docs["doc_id"].eqNullSafe(leaks["leak_id"]) & (_digest(docs["text"]) == leaks["leak_digest"])
    return docs.join(leaks, same, "left_anti")
