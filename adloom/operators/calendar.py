"""Day × campaign scaffold and the campaign-days that are missing from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.functions.days import Day, as_day, between_days


def calendar(start: Day, end: Day) -> Column:
    """Array of all days of a range, both ends included."""
    return F.sequence(as_day(start), as_day(end), F.expr("interval 1 day"))


def scaffold(campaigns: DataFrame, start: Day, end: Day, day_column: str = "date") -> DataFrame:
    """Every campaign on every day, both ends included.

    The days are a constant array unrolled per row: each task expands its own
    campaigns and no join takes place.
    """
    return campaigns.withColumn(day_column, F.explode(calendar(start, end)))


def missing_keys(required: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Required rows without a counterpart.

    The present side is reduced to distinct keys first, in part before its
    shuffle, so repeated keys cost nothing in the join.
    """
    return required.join(present.select(*keys).distinct(), list(keys), "left_anti")


def missing_campaign_days(raw: DataFrame, start: Day, end: Day) -> DataFrame:
    """Days in the range on which a campaign seen in it delivered nothing.

    Rows without a campaign are nobody's. One scan: campaign-days are made distinct, in part before the shuffle, so a
    campaign then gathers at most one entry per day of the range, and only its
    gaps are unrolled.
    """
    known = between_days("date", start, end) & F.col("campaign_id").isNotNull()
    seen = raw.where(known).select("campaign_id", "date").distinct()
    by_campaign = seen.groupBy("campaign_id").agg(F.collect_list("date").alias("days"))
    gaps = F.array_except(calendar(start, end), F.col("days"))
    return by_campaign.select("campaign_id", F.explode(gaps).alias("date"))


def missing_from_dimension(campaigns: DataFrame, raw: DataFrame, start: Day, end: Day) -> DataFrame:
    """Days of the range on which a campaign of the dimension delivered nothing.

    Each campaign meets its array of days, one row at most; only gaps are unrolled.
    """
    known = between_days("date", start, end) & F.col("campaign_id").isNotNull()
    seen = raw.where(known).select("campaign_id", "date").distinct()
    by_campaign = seen.groupBy("campaign_id").agg(F.collect_list("date").alias("days"))
    required = campaigns.select("campaign_id").where(F.col("campaign_id").isNotNull()).distinct()
    days = F.coalesce("days", F.array().cast("array<date>"))
    return required.join(by_campaign, "campaign_id", "left").select(
        "campaign_id", F.explode(F.array_except(calendar(start, end), days)).alias("date")
    )


def day_runs(rows: DataFrame, keys: Sequence[str], day_column: str = "date") -> DataFrame:
    """Keys with their runs of consecutive days: from_day, to_day, n_days.

    Days are made distinct first, in part before the shuffle. In a run of consecutive days the day
    less its rank among the key's days stays the same, which makes the runs by one grouping.
    """
    seen = rows.where(F.col(day_column).isNotNull()).select(*keys, F.col(day_column).alias("_day")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    return (
        seen.withColumn("_run", F.date_sub("_day", rank))
        .groupBy(*keys, "_run")
        .agg(F.min("_day").alias("from_day"), F.max("_day").alias("to_day"), F.count("*").alias("n_days"))
        .drop("_run")
    )


def missing_runs(raw: DataFrame, start: Day, end: Day) -> DataFrame:
    """campaign_id, from_day, to_day: the gaps of each campaign seen in the range, as intervals.

    A gap lies before a run of delivered days, or after the last one; the range itself is never
    unrolled, so ten years cost as many rows as there are gaps.
    """
    known = between_days("date", start, end) & F.col("campaign_id").isNotNull()
    runs = day_runs(raw.where(known), ["campaign_id"])
    by_day = Window.partitionBy("campaign_id").orderBy("from_day")
    before = F.coalesce(F.lag("to_day").over(by_day), F.date_sub(as_day(start), 1))
    last = F.lead("from_day").over(by_day).isNull()
    gap = lambda low, high: F.struct(low.alias("from_day"), high.alias("to_day"))
    gaps = F.array(
        gap(F.date_add("_before", 1), F.date_sub("from_day", 1)),
        F.when(F.col("_last"), gap(F.date_add("to_day", 1), as_day(end))),
    )
    return (
        runs.withColumns({"_before": before, "_last": last})
        .select("campaign_id", F.inline(F.filter(gaps, lambda g: g.getField("from_day") <= g.getField("to_day"))))
    )


def unrolled(gaps: DataFrame) -> DataFrame:
    """campaign_id, date: the days of gaps given as intervals."""
    return gaps.select("campaign_id", F.explode(calendar(F.col("from_day"), F.col("to_day"))).alias("date"))
