"""Ordered per-key operators that no single hot key can pull into one task.

A plain ``Window.partitionBy(device)`` sends every row of a device to one task, which fails once one
device holds a large share of a table. Here the windows run over a key and a *chunk*. A key of up to
``max_rows`` rows is one chunk, number 0, and is handled like a plain window. The rows of a larger
key, in their order, are cut into chunks 1, 2, ... What a chunk needs from the chunks before it (the
last value, the sum so far) is one small row per chunk, aggregated map-side, and joined back on key
and chunk; that join uses the partitioning of the window, so full rows are shuffled once.

Cuts follow the rows, not the clock: they are places of the whole order (time and ties) drawn from
the key's own rows by hash, so that a wrong clock far away or many rows of one instant are cut like any
others. Only rows alike in the whole order cannot be told apart and stay together. Finding the large keys
reads the key and order columns only. There are at most ``rows / max_rows`` of them, and at most
``DRAWS`` cuts for each ``max_rows`` rows, which bounds the broadcast. Where there are none, adaptive
execution drops the carrying part of the plan. Keys must not be null; without keys the whole table is one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
MAX_CHUNK_ROWS = 1_000_000
# Rows drawn for each ``max_rows`` rows; after half as many there is a cut.
DRAWS = 16
# Cuts looked through at a time when a row is placed.
STRIDE = 64


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """Add the chunk number, which never decreases along ``order`` within a key.

    Chunks of a large key hold about half of ``max_rows`` rows, and by the law of large numbers never twice that.
    """
    if CHUNK in df.columns:
        return df
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    place = F.struct(*order)
    narrow = df.select(*keys, place.alias("_place"))
    sizes = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows)
    # A row is drawn by the hash of its key and place, so every branch of a plan draws the same ones.
    draws = min(DRAWS, max_rows)
    every = max_rows // draws
    drawn = narrow.where(F.pmod(F.xxhash64(*keys, "_place"), F.lit(every)) == 0)
    drawn = drawn.join(F.broadcast(sizes.select(*keys)), keys) if keys else drawn.crossJoin(F.broadcast(sizes.select(F.lit(1).alias("_large"))))
    by_place = Window.partitionBy(*keys).orderBy("_place")
    cuts = (
        drawn.withColumn("_draw", F.row_number().over(by_place))
        .where(F.col("_draw") % max(draws // 2, 1) == 0)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set("_place")).alias("_cuts"))
        .where(F.size("_cuts") > 0)
        .withColumn("_steps", F.filter("_cuts", lambda _, i: i % STRIDE == 0))
    )
    # Cuts before the row: whole strides by their first cuts, then those of the last stride.
    stride = F.greatest(F.size(F.filter("_steps", lambda c: c < F.col("_here"))) - 1, F.lit(0)) * STRIDE
    before = stride + F.size(F.filter(F.slice("_cuts", stride + 1, STRIDE), lambda c: c < F.col("_here")))
    number = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(before + 1)
    placed = df.withColumn("_here", place)
    found = placed.join(F.broadcast(cuts), keys, "left") if keys else placed.join(F.broadcast(cuts), F.lit(True), "left")
    return found.withColumn(CHUNK, number.cast("bigint")).select(*df.columns, CHUNK)


def _inside(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(name) for name in order])


def _upto_row(keys: Sequence[str], order: Sequence[str]) -> Window:
    return _inside(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _across(keys: Sequence[str]) -> Window:
    """A key's chunks in order; one small row each."""
    return Window.partitionBy(*keys).orderBy(CHUNK)


def _chunks_before(keys: Sequence[str]) -> Window:
    return _across(keys).rowsBetween(Window.unboundedPreceding, -1)


def _per_chunk(source: DataFrame, keys: Sequence[str], *summaries: Column) -> DataFrame:
    """One row per chunk of the large keys."""
    return source.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK).agg(*summaries)


def _completed(near: DataFrame, carried: DataFrame, keys: Sequence[str], df: DataFrame, *results: Column) -> DataFrame:
    """Join what chunks carry to their rows and keep the columns of ``df``, the chunk and ``results``."""
    joined = near.join(carried, [*keys, CHUNK], "left")
    return joined.select(*[F.col(name) for name in df.columns if name != CHUNK], F.col(CHUNK), *results)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], **chunking
) -> DataFrame:
    """``lag`` by one row: ``values`` maps new columns to what they take from the row before."""
    return _neighbour(df, keys, order, values, F.lag, F.max_by, **chunking)


def following(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], **chunking
) -> DataFrame:
    """``lead`` by one row: ``values`` maps new columns to what they take from the row after."""
    return _neighbour(df, keys, order, values, F.lead, F.min_by, **chunking)


def _neighbour(df, keys, order, values, shift, edge, **chunking) -> DataFrame:
    source = chunked(df, keys, order, **chunking)
    packed = F.struct(*[value.alias(name) for name, value in values.items()])
    edges = _per_chunk(source, keys, edge(packed, F.struct(*order)).alias("_edge"))
    carried = edges.select(*keys, CHUNK, shift("_edge").over(_across(keys)).alias("_carried"))
    near = source.withColumn("_near", shift(packed).over(_inside(keys, order)))
    found = F.coalesce("_near", "_carried")
    return _completed(near, carried, keys, df, *[found[name].alias(name) for name in values])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], **chunking
) -> DataFrame:
    """Sum from the first row of the key up to and including the current one."""

    def added(before: Column, near: Column) -> Column:
        return F.coalesce(before + near, near, before)

    return _running(df, keys, order, values, F.sum, added, **chunking)


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], **chunking
) -> DataFrame:
    """Largest value from the first row of the key up to and including the current one."""
    return _running(df, keys, order, values, F.max, F.greatest, **chunking)


def _running(df, keys, order, values, total, combine, **chunking) -> DataFrame:
    source = chunked(df, keys, order, **chunking)
    sums = _per_chunk(source, keys, *[total(value).alias(f"_all_{name}") for name, value in values.items()])
    carried = sums.select(
        *keys, CHUNK, *[total(f"_all_{name}").over(_chunks_before(keys)).alias(f"_before_{name}") for name in values]
    )
    near = source.select(
        "*", *[total(value).over(_upto_row(keys, order)).alias(f"_near_{name}") for name, value in values.items()]
    )
    results = [combine(F.col(f"_before_{name}"), F.col(f"_near_{name}")).alias(name) for name in values]
    return _completed(near, carried, keys, df, *results)


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column, **chunking
) -> DataFrame:
    """Latest ``value`` that is not null, at the current row or before it."""
    source = chunked(df, keys, order, **chunking)
    place = F.when(value.isNotNull(), F.struct(*order))
    tails = _per_chunk(source, keys, F.max_by(value, place).alias("_tail"))
    latest = F.last("_tail", ignorenulls=True).over(_chunks_before(keys))
    carried = tails.select(*keys, CHUNK, latest.alias("_carried"))
    near = source.withColumn("_near", F.last(value, ignorenulls=True).over(_upto_row(keys, order)))
    return _completed(near, carried, keys, df, F.coalesce("_near", "_carried").alias(name))


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number", **chunking
) -> DataFrame:
    """``row_number`` per key."""
    return running_sum(df, keys, order, {name: F.lit(1).cast("bigint")}, **chunking)


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    values: dict[str, Column],
    block_rows: int = 100_000,
    **chunking,
) -> DataFrame:
    """Aggregates over the ``rows`` rows before the current one.

    Rows get their number within the key, numbers are cut into equal blocks, and the last ``rows``
    rows of a block are handed to the next one as read-only context, so blocks are even whatever the
    key's share. ``values`` maps new columns to aggregate expressions.
    """
    if block_rows < rows:
        raise ValueError("block_rows must not be less than rows")
    counted = numbered(df, keys, order, "_number", **chunking).drop(CHUNK)
    block = F.floor((F.col("_number") - 1) / F.lit(block_rows))
    within = (F.col("_number") - 1) % block_rows
    homes = F.when(within >= block_rows - rows, F.array(block, block + 1)).otherwise(F.array(block))
    spread = counted.select("*", F.posexplode(homes).alias("_copy", "_block"))
    frame = Window.partitionBy(*keys, "_block").orderBy("_number").rowsBetween(-rows, -1)
    windowed = spread.select(
        *df.columns, "_copy", *[value.over(frame).alias(name) for name, value in values.items()]
    )
    return windowed.where(F.col("_copy") == 0).drop("_copy")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key (nulls last), merged map-side before the shuffle."""
    return _one_per_key(df, keys, F.max_by(F.struct(*df.columns), F.struct(*order)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, merged map-side before the shuffle."""
    return _one_per_key(df, keys, F.min_by(F.struct(*df.columns), F.struct(*order)))


def _one_per_key(df: DataFrame, keys: Sequence[str], kept: Column) -> DataFrame:
    return df.groupBy(*keys).agg(kept.alias("_row")).select("_row.*")
