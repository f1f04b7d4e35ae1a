"""Aggregates whose result does not depend on the order rows arrive in.

Floating-point addition is not associative, so a distributed ``sum`` or ``avg``
over doubles can differ in its last digits between two runs (task order, retries
after a lost executor). Here each value is first taken to the decimal number it stands
for and then added as integer limbs, which is exact, stays in generated code (several
times as fast as adding decimals) and turns into a decimal once per group.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limbs are below this, so that 9 * 10^12 of them add up within a long.
LIMB = 1_000_000
#: Decimal digits that a double is sure to carry, and decimal places of a total.
CARRIED, PLACES = 15, 12


def _trillionths(value: Column, whole: Column) -> Column:
    """The part of a value above its floor in units of 10^-12.

    It is rounded at the places that the double carries besides its whole digits: beyond
    them stands the binary rest of a decimal number, which must not be added up.
    """
    above = value - whole

    def rounded(places: int) -> Column:
        nearest = F.rint(above * float(10**places)).cast("bigint")
        return nearest if places == PLACES else nearest * 10 ** (PLACES - places)

    size = F.abs(value)
    most = CARRIED - PLACES
    cases = F.when(size < float(10**most), rounded(PLACES))
    for digits in range(most + 1, CARRIED):
        cases = cases.when(size < float(10**digits), rounded(CARRIED - digits))
    return cases.otherwise(rounded(0))


def exact_total(value: Column) -> Column:
    """Decimal sum of the values as ``decimal(38,12)``; NULL for none.

    A double counts as the decimal number of at most 15 significant digits and 12 decimal
    places that it is nearest to: for every such number, of either sign and below 10^15, the
    sum is that of the decimal texts. A longer value is rounded there, at 15 digits or 12
    places, whichever comes first. Values of 2^63 and more, totals of 10^22 and more, infinities and values that are
    not numbers stop the query.
    """
    whole = F.floor(value).cast("bigint")
    part = _trillionths(value, whole)
    limb = F.lit(LIMB)
    # Quotient and remainder both have the sign of the whole, so they add up to it.
    limbs = (
        (F.rint((whole - whole % limb) / limb).cast("bigint"), "decimal(7,0)", "1000000"),
        (whole % limb, "decimal(13,12)", "1"),
        (F.floor(part / limb), "decimal(13,12)", "0.000001"),
        (part % limb, "decimal(13,12)", "0.000000000001"),
    )

    def term(amount: Column, kind: str, unit: str) -> Column:
        units = F.sum(amount).cast("decimal(20,0)") * F.lit(Decimal(unit)).cast(kind)
        return units.cast("decimal(34,12)")

    return reduce(Column.__add__, (term(*each) for each in limbs)).cast("decimal(38,12)")


def exact_sum(column: str) -> Column:
    return exact_total(F.col(column)).cast("double")


def exact_avg(column: str) -> Column:
    """Mean of the non-NULL values; NULL for none."""
    return F.try_divide(exact_sum(column), F.count(column).cast("double"))
