"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import written


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``links`` (columns ``a, b``).

    Alternating stars: every id's larger neighbours are linked to its smallest one, then its smaller ones, until
    each component is a star around its smallest id. Each step is two aggregations and joins of
    links; a step's result is written, so a lost executor costs one step.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.col("k")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Now the smaller side: each id's smaller neighbours, and itself, to the smallest of them.
        small_least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(small_least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(small_least.select(F.col("k").alias("u"), F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "links")
        sign = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())
        if sign == before:
            break
        before = sign
    pairs = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return pairs.unionByName(roots.join(pairs.select("id"), "id", "left_anti"))
