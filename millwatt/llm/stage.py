"""Tables written to the shared folder, so that later steps survive a lost executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt.session import work_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it again: its lineage ends there."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def sampled(df: DataFrame, key: str, bound: int, seed: int) -> DataFrame:
    """All rows when there are at most ``bound``, else about ``bound`` (within a few times its square root),
    chosen by the hash of their key. For fitting models only; nothing is collected but one count."""
    rows = df.count()
    return df if rows <= bound else df.where(share(F.col(key), seed) < bound / rows)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, to be broadcast in joins when it has at most ``rows`` rows; else Spark shuffles it."""
    return F.broadcast(df) if df.count() <= rows else df


def free(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
