"""Decimal rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(value: Column, digits: int) -> Column:
    """The multiple of a power of ten that is nearest to the double itself, ties to even.

    ``F.bround`` rounds the shortest decimal text of a double, which may lie on a
    tie where the double does not. The fraction times 2^60 is a whole number (below
    2^-8 what is cut off cannot matter), so the comparison with one half is exact. For
    non-negative values below 2^53 over the scale, and up to three digits.
    """
    one, scale = 1 << 60, 10**digits
    whole = F.floor(value)
    fraction = ((value - whole) * F.lit(float(one))).cast("bigint").cast("decimal(38,0)") * scale
    fraction = fraction.cast("decimal(38,0)")
    unit = F.lit(one).cast("decimal(20,0)")
    down = F.floor(fraction / unit).cast("bigint")
    rest = (fraction - down * unit).cast("decimal(38,0)") * 2
    below = whole * scale + down
    up = (rest > unit) | ((rest == unit) & (below % 2 != 0))
    return F.when(value.isNotNull(), (below + up.cast("bigint")) / F.lit(float(scale)))
