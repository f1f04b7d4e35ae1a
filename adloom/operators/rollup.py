"""Partial states of the analysis queries by day, and rolling windows made of them.

A day's state holds what adds up: counts and exact decimal sums, and for distinct campaigns a bitmap of
campaign numbers. A window is the sum of its days, and the next day's window is the last one with the
day that enters added and the day that leaves taken away, so no query reads the mart again: sums
are decimals, and taking a day away gives exactly what the other days add up to. Bitmaps can't be taken away; a
window takes the union of its days' bitmaps, a few rows for each platform and day.

Campaigns are numbered once, in a dictionary. Each task numbers its new campaigns in a row, so numbers are
dense within blocks and a bitmap of 32 768 numbers holds many of them. A NULL campaign has no number
and, as in a distinct count, is none.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.aggregates import exact_total
from adloom.functions.days import Day, as_day, day_before
from adloom.functions.kpis import CURRENCY_DIGITS, RATIO_DIGITS

#: Numbers of one task's campaigns lie in a block of their own.
BLOCK = 1 << 33

#: Additive parts of a state: name -> aggregate over mart rows.
SUMMED = ("spend", "ctr", "cpa", "roas")
COUNTED = ("ctr", "cpa", "roas")
WHOLE = ("impressions", "conversions")


def number_campaigns(mart: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """campaign_id, number: the known campaigns as they are, the others numbered after them.

    The result must be stored before it's used: numbers are given by task.
    """
    found = mart.select("campaign_id").where("campaign_id is not null").distinct()
    if known is None:
        return found.select("campaign_id", F.monotonically_increasing_id().alias("number"))
    last = known.agg(F.max("number")).first()[0]
    start = 0 if last is None else (last // BLOCK + 1) * BLOCK
    fresh = found.join(known, "campaign_id", "left_anti")
    return known.select("campaign_id", "number").unionByName(
        fresh.select("campaign_id", (F.monotonically_increasing_id() + start).alias("number"))
    )


def _parts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count(c).alias(f"n_{c}") for c in COUNTED),
        *(F.count(c).alias(f"n_{c}") for c in WHOLE),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}") for c in WHOLE),
        *(F.coalesce(exact_total(F.col(c)), F.lit(0)).cast("decimal(38,12)").alias(f"total_{c}") for c in SUMMED),
        F.count("spend").alias("n_spend"),
    ]


PARTS = (
    "n_rows", *(f"n_{c}" for c in (*COUNTED, *WHOLE, "spend")), *(f"sum_{c}" for c in WHOLE),
    *(f"total_{c}" for c in SUMMED),
)


def daily_states(mart: DataFrame, by: Sequence[str] = ("platform",)) -> DataFrame:
    """report_date, the grouping columns and the additive parts; one row for each day and group."""
    return mart.groupBy("report_date", *by).agg(*_parts())


def daily_bitmaps(mart: DataFrame, numbers: DataFrame, by: Sequence[str] = ("platform",)) -> DataFrame:
    """report_date, the grouping columns, bucket, bitmap: which campaigns a day has."""
    seen = mart.select("report_date", *by, "campaign_id").distinct().join(numbers, "campaign_id")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return seen.groupBy("report_date", *by, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def _added(states: DataFrame, by: Sequence[str]) -> DataFrame:
    def total(part: str) -> Column:
        kind = "decimal(38,12)" if part.startswith("total_") else "bigint"
        return F.sum(part).cast(kind).alias(part)

    return states.groupBy(*by).agg(*(total(p) for p in PARTS)).where("n_rows > 0")


def window_state(states: DataFrame, as_of: Day, days: int, by: Sequence[str] = ("platform",)) -> DataFrame:
    """The state of the days from ``days`` before ``as_of`` on."""
    return _added(states.where(F.col("report_date") >= day_before(as_of, days)), by)


def advance(
    window: DataFrame, states: DataFrame, as_of: Day, days: int, by: Sequence[str] = ("platform",)
) -> DataFrame:
    """The window of ``as_of`` from that of the day before: one day enters, one leaves."""
    columns = [*by, *PARTS]
    enters = states.where(F.col("report_date") == as_day(as_of))
    leaves = states.where(F.col("report_date") == day_before(as_of, days + 1))
    taken = leaves.select(*by, *((-F.col(p)).alias(p) for p in PARTS))
    return _added(reduce(DataFrame.unionByName, (window.select(*columns), enters.select(*columns), taken)), by)


def distinct_campaigns(
    bitmaps: DataFrame, as_of: Day, days: int, by: Sequence[str] = ("platform",)
) -> DataFrame:
    """The grouping columns and nb_campagnes: exact distinct campaigns of a window."""
    near = bitmaps.where(F.col("report_date") >= day_before(as_of, days))
    merged = near.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("nb_campagnes"))


def rolling_campaigns(bitmaps: DataFrame, days: int, by: Sequence[str] = ("platform",)) -> DataFrame:
    """as_of, the grouping columns and nb_campagnes: exact distinct campaigns of the window of every day.

    A day's bitmap is part of the windows of the ``days`` days after it; windows that end after the
    last day are left out.
    """
    last = bitmaps.agg(F.max("report_date").alias("_last"))
    ends = F.sequence("report_date", F.least(F.date_add("report_date", days), F.col("_last")))
    spread = bitmaps.join(F.broadcast(last)).select(*by, "bucket", "bitmap", F.explode(ends).alias("as_of"))
    merged = spread.groupBy("as_of", *by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("as_of", *by).agg(F.sum(F.bitmap_count("bitmap")).alias("nb_campagnes"))


def _mean(column: str) -> Column:
    return F.try_divide(_total(column), F.col(f"n_{column}").cast("double"))


def _total(column: str) -> Column:
    return F.when(F.col(f"n_{column}") > 0, F.col(f"total_{column}").cast("double"))


def _whole(column: str) -> Column:
    return F.when(F.col(f"n_{column}") > 0, F.col(f"sum_{column}"))


def platform_comparison(window: DataFrame, distinct: DataFrame, rounded: bool = True) -> DataFrame:
    """The platforms side by side, as over the mart, from a window's state."""
    joined = window.join(distinct, "platform", "left")
    roas = _mean("roas")
    return joined.select(
        "platform",
        F.coalesce("nb_campagnes", F.lit(0)).alias("nb_campagnes"),
        _whole("impressions").alias("total_impressions"),
        _mean("ctr").alias("ctr_moyen"),
        _total("spend").alias("depense_totale"),
        *([F.round(_mean("cpa"), CURRENCY_DIGITS).alias("cpa_moyen")] if rounded else []),
        (F.round(roas, RATIO_DIGITS) if rounded else roas).alias("roas_moyen"),
    )


CAMPAIGN = ("campaign_name", "platform")


def top_roas(window: DataFrame, limit: int = 10) -> DataFrame:
    """Best campaigns by mean daily ROAS, of those with conversions, from a window's state."""
    return (
        window.select(
            *CAMPAIGN,
            _total("spend").alias("total_spend"),
            _whole("conversions").alias("total_conversions"),
            F.round(_mean("roas"), RATIO_DIGITS).alias("avg_roas"),
        )
        .where("total_conversions > 0")
        .orderBy(F.desc("avg_roas"), *CAMPAIGN)
        .limit(limit)
    )


def top_spend(window: DataFrame, limit: int = 10) -> DataFrame:
    """Campaigns with the highest spend, from a window's state."""
    return (
        window.select(*CAMPAIGN, _total("spend").alias("total_spend"), _mean("roas").alias("avg_roas"))
        .orderBy(F.desc("total_spend"), *CAMPAIGN)
        .limit(limit)
    )
