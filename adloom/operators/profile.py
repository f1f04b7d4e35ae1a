"""Summary of an ingested batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.aggregates import exact_sum


def ingestion_profile(batch: DataFrame, spend_column: str) -> DataFrame:
    """Rows, period covered, campaigns and spend, in one row.

    Campaigns are reduced per task before they meet, like every exact distinct
    count; an absent spend counts as zero.
    """
    return batch.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("campaign_id").alias("unique_campaigns"),
        F.coalesce(exact_sum(spend_column), F.lit(0.0)).alias("total_spend"),
    )
