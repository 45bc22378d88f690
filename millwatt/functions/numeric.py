"""Casting, exact sums and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readings are exact decimals, so sums do not depend on the order rows arrive in.
NUMERIC = "decimal(28,12)"


def numeric(value: Column) -> Column:
    """A reading as an exact number; text that is no number becomes null, not an error."""
    return value.try_cast(NUMERIC)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null where ``whole`` is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mean(value: Column) -> Column:
    """Average from an exact sum; one division at the end."""
    return ratio(F.sum(value), F.count(value))


def half_up(value: Column, places: int) -> Column:
    """Round half away from zero on the decimal digits of ``value``."""
    return F.round(value.cast("decimal(28,10)"), places)
