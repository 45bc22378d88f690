"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue: its documents in shuffled order, and after the last one the same order again, as often as
``repeats`` allows. An item's virtual finish time is the tokens its source has offered up to its end, divided by the
source's target; the mix is the stream of all items sorted by that time, cut at the total budget. When every
queue has given ``v`` times its target, the mix holds ``v`` times the sum of targets, so the cut lies at the virtual
time ``budget / sum of targets``; the item of each source that straddles it gives the words before it.

Native DataFrame functions only. A source may hold a third of all documents: running sums are taken over pieces of
the shuffle order (1024 for each source, whatever its size), and pieces are offset by their sums, one row each.

Defined results: a null text has size 0 and gives nothing; null sources are one source, last in order; a null id is
shuffled like any other; equal rows are interchangeable and each comes out once; an empty table gives no rows;
columns other than ``doc_id, text, source`` are not read. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import word_count

WEIGHTS = (5, 2, 1)
SEED = "mix"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, repeats: int = 2) -> DataFrame:
    """A row for each source: ``source_key, source_size, target``.

    ``sizes`` has ``source_key, source, source_size``. Weights go round the sources in code point order. Targets
    share ``percent`` of all sizes by weight, none above ``repeats`` times its source. Sources ordered by cap over
    weight fill up one after the other, so the common level of the rest follows from sums over the filled ones.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # windows over one row per source
    weighed = sizes.withColumn("turn", F.row_number().over(by_name) - 1).select(
        "source_key",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        (repeats * F.col("source_size")).alias("cap"),
    )
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    upto = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("filled", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("open_weight", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(everything) * percent / 100)
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("open_weight"))
        .withColumn("place", F.row_number().over(fill))
    )
    holds = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("place", "level"))
    common = levels.withColumn("common", F.min(holds).over(everything)["level"])
    return common.select(
        "source_key",
        "source_size",
        F.least(
            F.col("cap").cast("double"),
            F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double")),
        ).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = 150,
    repeats: int = 2,
    fraction: float = 1.0,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, finish, taken`` for every document, by virtual finish time.

    ``fraction`` cuts the mix at that part of the sum of targets. ``finish`` is the virtual time at which the
    first copy of the document ends; ``taken`` counts its words in the mix, repeats included.
    """
    key = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    items = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
        key.alias("turn"),
    )
    # The leading ten bits, so that pieces follow the shuffle order.
    items = items.withColumn("piece", F.shiftright(F.conv(F.substring("turn", 1, 3), 16, 10).cast("int"), 2))
    pieces = items.groupBy("source_key", "piece").agg(F.sum("size").alias("piece_size"), F.first("source").alias("source"))
    earlier = Window.partitionBy("source_key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "source_key", "piece", F.coalesce(F.sum("piece_size").over(earlier), F.lit(0)).alias("offset")
    )
    sizes = pieces.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("piece_size").alias("source_size"))
    plan = offsets.join(targets(sizes, weights, percent, repeats), "source_key")
    in_turn = Window.partitionBy("source_key", "piece").orderBy("turn", "doc_id", "size")
    within = in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = (
        items.withColumn("inner", F.sum("size").over(within))
        .join(plan, ["source_key", "piece"])
        .withColumn("end", F.col("offset") + F.col("inner"))
    )
    cut = F.floor(F.col("target") * F.lit(fraction))
    copies = [
        F.least(F.greatest(cut - k * F.col("source_size") - F.col("end") + F.col("size"), F.lit(0)), F.col("size"))
        for k in range(repeats)
    ]
    taken = sum(copies[1:], copies[0])
    return queued.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("target") > 0, F.col("end") / F.col("target")).otherwise(F.lit(0.0)).alias("finish"),
        taken.cast("long").alias("taken"),
    ).orderBy("finish", "doc_id")
