"""Open-ended readings as ``VARIANT``: members of any depth and type, read by path when a query needs them.

The map of numbers suits devices that send flat numbers. A device that nests members or mixes types keeps its message as it came in a
``VARIANT`` column, which Parquet stores as typed binary, and a member that cannot be read as the type asked for is null, not an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatt.functions.numeric import NUMERIC


def parse(text: Column) -> Column:
    """JSON text as a variant; null for text that is no JSON."""
    return F.try_parse_json(text)


def member(variant: Column, path: str, kind: str) -> Column:
    """The member at ``path`` (``$.a.b[0]``) as ``kind``; null where it is missing or cannot be one."""
    return F.try_variant_get(variant, path, kind)


def number(variant: Column, path: str) -> Column:
    """A reading as an exact number, also from text that holds one, as :func:`millwatt.functions.numeric.numeric` reads it."""
    return F.coalesce(member(variant, path, NUMERIC), member(variant, path, "string").try_cast(NUMERIC))


def members(messages: DataFrame, variant: str, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns from a variant column: name to path and type."""
    return messages.select(*[c for c in messages.columns if c != variant], *[member(F.col(variant), p, k).alias(n) for n, (p, k) in wanted.items()])


def shapes(messages: DataFrame, variant: str, *keys: str) -> DataFrame:
    """The schema that the messages of each key have together, for finding members no query knows yet."""
    return messages.groupBy(*keys).agg(F.schema_of_variant_agg(F.col(variant)).alias("shape"))
