"""Ratio KPIs with null-safe division.

A KPI is NULL whenever its denominator is NULL, zero or negative; it is never
infinite or NaN. Ratios keep four digits, currency amounts two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


RATIO_DIGITS = 4
CURRENCY_DIGITS = 2

# name -> (numerator, denominator, digits)
KPIS = {
    "ctr": ("clicks", "impressions", RATIO_DIGITS),
    "cpa": ("spend", "conversions", CURRENCY_DIGITS),
    "roas": ("conversions", "spend", RATIO_DIGITS),
    "cpc": ("spend", "clicks", CURRENCY_DIGITS),
    "conversion_rate": ("conversions", "clicks", RATIO_DIGITS),
}

# Fixed target values of the KPI catalogue.
CTR_TARGET = 0.02
CPA_TARGET = 5
CONVERSION_RATE_TARGET = 0.05

# Fixed efficiency bands: lowest ROAS of the band, label; the last label has no floor.
EFFICIENCY_BANDS = ((3, "Excellent"), (2, "Bon"), (1, "Acceptable"))
EFFICIENCY_REST = "À Améliorer"


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Floating-point quotient; NULL for a zero or NULL operand."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio(numerator: str, denominator: str, digits: int) -> Column:
    n, d = F.col(numerator), F.col(denominator)
    return F.when(d > 0, F.round(safe_divide(n, d), digits))


def kpi(name: str) -> Column:
    return ratio(*KPIS[name]).alias(name)


def kpi_columns() -> list[Column]:
    return [kpi(name) for name in KPIS]


def target_flags() -> list[Column]:
    """Whether each KPI meets its target; unknown where the KPI is unknown."""
    return [
        (F.col("ctr") > CTR_TARGET).alias("meets_ctr_target"),
        (F.col("cpa") < CPA_TARGET).alias("meets_cpa_target"),
        (F.col("conversion_rate") > CONVERSION_RATE_TARGET).alias("meets_conversion_rate_target"),
    ]


def efficiency_band(roas: Column) -> Column:
    """Label of the highest band reached; an unknown ROAS falls into the rest."""
    first, *others = EFFICIENCY_BANDS
    band = F.when(roas >= first[0], first[1])
    for floor, label in others:
        band = band.when(roas >= floor, label)
    return band.otherwise(EFFICIENCY_REST)


def deviates(kpi_name: str, tolerance: float) -> Column:
    """True where a stored KPI is further than ``tolerance`` from its formula."""
    numerator, denominator, _ = KPIS[kpi_name]
    expected = safe_divide(F.col(numerator), F.col(denominator))
    return (
        (F.col(denominator) > 0)
        & F.col(kpi_name).isNotNull()
        & (F.abs(expected - F.col(kpi_name)) > tolerance)
    )
