"""Analysis queries over the mart.

Each takes ``as_of`` in place of the current day. Sorted results carry the grain
as trailing sort keys: rows that tie on the leading ones (every row without a
ROAS, say) would otherwise all fall into one range partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.aggregates import exact_avg, exact_sum
from adloom.functions.days import Day, day_before, within_last
from adloom.functions.kpis import CURRENCY_DIGITS, RATIO_DIGITS, efficiency_band


def top_roas(mart: DataFrame, as_of: Day = None, days: int = 30, limit: int = 10) -> DataFrame:
    """Best campaigns by mean daily ROAS, of those with conversions."""
    return (
        mart.where(within_last("report_date", as_of, days))
        .groupBy("campaign_name", "platform")
        .agg(
            exact_sum("spend").alias("total_spend"),
            F.sum("conversions").alias("total_conversions"),
            F.round(exact_avg("roas"), RATIO_DIGITS).alias("avg_roas"),
        )
        .where(F.col("total_conversions") > 0)
        .orderBy(F.desc("avg_roas"), "campaign_name", "platform")
        .limit(limit)
    )


def top_spend(mart: DataFrame, as_of: Day = None, days: int = 30, limit: int = 10) -> DataFrame:
    """Campaigns with the highest spend."""
    return (
        mart.where(within_last("report_date", as_of, days))
        .groupBy("campaign_name", "platform")
        .agg(exact_sum("spend").alias("total_spend"), exact_avg("roas").alias("avg_roas"))
        .orderBy(F.desc("total_spend"), "campaign_name", "platform")
        .limit(limit)
    )


def platform_comparison(mart: DataFrame, as_of: Day = None, days: int = 7) -> DataFrame:
    """Platforms side by side; mean CPA and ROAS rounded."""
    return (
        mart.where(within_last("report_date", as_of, days))
        .groupBy("platform")
        .agg(
            F.count_distinct("campaign_id").alias("nb_campagnes"),
            F.sum("impressions").alias("total_impressions"),
            exact_avg("ctr").alias("ctr_moyen"),
            exact_sum("spend").alias("depense_totale"),
            F.round(exact_avg("cpa"), CURRENCY_DIGITS).alias("cpa_moyen"),
            F.round(exact_avg("roas"), RATIO_DIGITS).alias("roas_moyen"),
        )
    )


def platform_comparison_raw(mart: DataFrame, as_of: Day = None, days: int = 7) -> DataFrame:
    """Platforms side by side, means unrounded."""
    return (
        mart.where(within_last("report_date", as_of, days))
        .groupBy("platform")
        .agg(
            F.count_distinct("campaign_id").alias("nb_campagnes"),
            F.sum("impressions").alias("total_impressions"),
            exact_avg("ctr").alias("ctr_moyen"),
            exact_sum("spend").alias("depense_totale"),
            exact_avg("roas").alias("roas_moyen"),
        )
    )


def daily_trend(
    mart: DataFrame, campaign_name: str, as_of: Day = None, days: int = 30
) -> DataFrame:
    """Day by day figures of one campaign, newest first."""
    return (
        mart.where(F.col("campaign_name") == campaign_name)
        .where(within_last("report_date", as_of, days))
        .orderBy(F.desc("report_date"), "platform", "campaign_id")
        .select(
            "report_date",
            "campaign_name",
            "impressions",
            "clicks",
            "ctr",
            "spend",
            "conversions",
            "cpa",
            "roas",
        )
    )


def efficiency_bands(mart: DataFrame, as_of: Day = None) -> DataFrame:
    """Campaigns of the day before, by efficiency band and ROAS."""
    return (
        mart.where(F.col("report_date") == day_before(as_of))
        .withColumn("notation_efficacite", efficiency_band(F.col("roas")))
        .orderBy("notation_efficacite", F.desc("roas"), "platform", "campaign_name", "campaign_id")
        .select(
            "campaign_name",
            "platform",
            "notation_efficacite",
            F.round("roas", RATIO_DIGITS).alias("roas"),
            F.round("cpa", CURRENCY_DIGITS).alias("cpa"),
        )
    )
