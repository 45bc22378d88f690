"""Register blocks: two 16-bit words, high word first, hold one IEEE-754 single.

Words are taken apart and put together with integer and double arithmetic, which is exact here, so
the codec is ordinary expression work and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def single_from_words(high: Column, low: Column) -> Column:
    """The double equal to the single stored in ``high`` and ``low``."""
    high = high.cast("int").bitwiseAND(F.lit(0xFFFF))
    low = low.cast("int").bitwiseAND(F.lit(0xFFFF))
    sign = F.when(high >= 0x8000, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.shiftright(high, 7).bitwiseAND(F.lit(0xFF))
    fraction = (high.bitwiseAND(F.lit(0x7F)) * 65536 + low).cast("double")
    normal = (1.0 + fraction / F.lit(8388608.0)) * F.pow(F.lit(2.0), (exponent - 127).cast("double"))
    subnormal = fraction * F.pow(F.lit(2.0), F.lit(-149.0))
    special = F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    magnitude = F.when(exponent == 255, special).when(exponent == 0, subnormal).otherwise(normal)
    return sign * magnitude


def decode_block(registers: Column) -> Column:
    """Register array to the array of readings; a trailing odd word is ignored."""
    count = F.floor(F.size(registers) / 2).cast("int")
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.expr("cast(array() as array<int>)")
    )
    return F.transform(
        places,
        lambda i: single_from_words(F.get(registers, i * 2), F.get(registers, i * 2 + 1)),
    )


def decode_metrics(registers: Column, keys: Column) -> Column:
    """Readings by metric key, keys in register order; a short block yields its first keys only."""
    count = F.least(F.size(keys), F.floor(F.size(registers) / 2).cast("int"))
    return F.map_from_arrays(
        F.slice(keys, F.lit(1), count), F.slice(decode_block(registers), F.lit(1), count)
    )


def encode_block(values: Column) -> Column:
    """Array of readings, rounded to singles, to the register array; null readings give null words.

    Each step is a pass over the array, so a step's result is computed once per reading.
    """
    two = F.lit(2.0)
    infinite = F.lit(255 * 8388608)

    def measured(value: Column) -> Column:
        single = value.cast("float").cast("double")
        # The logarithm may be off by one next to a power of two.
        finite = (single != 0) & (F.abs(single) < float("inf"))
        guess = F.floor(F.log2(F.when(finite, F.abs(single))))
        return F.struct(single.alias("single"), F.abs(single).alias("size"), guess.alias("guess"))

    def scaled(s: Column) -> Column:
        power = (
            F.when(s["size"] >= F.pow(two, s["guess"] + 1), s["guess"] + 1)
            .when(s["size"] < F.pow(two, s["guess"]), s["guess"] - 1)
            .otherwise(s["guess"])
        )
        return F.struct(s["single"].alias("single"), s["size"].alias("size"), power.alias("power"))

    def packed(s: Column) -> Column:
        size, power = s["size"], s["power"]
        subnormal = F.round(size * F.pow(two, F.lit(149.0))).cast("bigint")
        fraction = F.round((size / F.pow(two, power) - 1) * 8388608).cast("bigint")
        bits = (
            F.when(F.isnan(size), infinite + 4194304)
            .when(size == float("inf"), infinite)
            .when(size < 2.0**-126, subnormal)
            .otherwise((power + 127) * 8388608 + fraction)
        )
        negative = F.when(size == 0, s["single"].cast("string") == "-0.0").otherwise(s["single"] < 0)
        return F.struct(bits.alias("bits"), F.when(negative, 32768).otherwise(0).alias("sign"))

    def split(s: Column) -> Column:
        high = F.floor(s["bits"] / 65536) + s["sign"]
        return F.array(high.cast("int"), (s["bits"] % 65536).cast("int"))

    steps = values
    for step in (measured, scaled, packed, split):
        steps = F.transform(steps, step)
    return F.flatten(steps)
