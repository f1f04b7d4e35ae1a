"""Explicit schemas of every layer, and the values that are fixed by contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: platform tags, layer names, action types, thresholds -------
GOOGLE = "google_ads"
META = "meta_ads"
PLATFORMS = (GOOGLE, META)

RAW_GOOGLE_TABLE = "google_ads_campaign_daily"
RAW_META_TABLE = "meta_ads_campaign_daily"
STG_GOOGLE_TABLE = "stg_google_ads__campaign_daily"
STG_META_TABLE = "stg_meta_ads__campaign_daily"
UNIFIED_TABLE = "int_campaign_daily_unified"
MART_TABLE = "mart_campaign_daily"
RUN_SUMMARY_TABLE = "run_summary"
LEDGER_TABLE = "ingestion_ledger"

ENGAGEMENT_ACTIONS = {
    "likes": "post_reaction",
    "comments": "comment",
    "shares": "post",
    "video_views": "video_view",
    "page_engagement": "page_engagement",
}

LATE_DATA_DAYS = 7
RECENCY_DAYS = 7
VIOLATION_REPORT_ROWS = 1000

# (layer, table, min rows a day, max rows a day, max day-over-day percent, description)
VOLUME_THRESHOLDS = (
    ("marts", MART_TABLE, 10, 100000, 50, "Daily campaign performance metrics"),
    ("staging", STG_GOOGLE_TABLE, 5, 50000, 50, "Google Ads staging layer"),
    ("staging", STG_META_TABLE, 5, 50000, 50, "Meta Ads staging layer"),
    ("raw", RAW_GOOGLE_TABLE, 1, 50000, 70, "Google Ads raw extraction"),
    ("raw", RAW_META_TABLE, 1, 50000, 70, "Meta Ads raw extraction"),
)
# ------------------------------------------------------------------------------

METADATA_COLUMNS = ("ingested_at", "extract_run_id", "source")
GRAIN = ("report_date", "campaign_id", "platform")
RAW_KEY = ("date", "campaign_id")


def _struct(**types: str | T.DataType) -> T.StructType:
    struct = T.StructType()
    for name, data_type in types.items():
        struct.add(name, data_type)
    return struct


GOOGLE_RECORD = _struct(
    date="date", campaign_id="string", campaign_name="string", impressions="long", clicks="long",
    conversions="long", cost_usd="double",
)

# Superset of the flat and the nested path: a field one of them lacks reads as NULL.
META_RECORD = _struct(
    date="date", campaign_id="string", campaign_name="string", impressions="long", clicks="long",
    conversions="long", spend_usd="double", likes="long", comments="long", shares="long",
    video_views="long", page_engagement="long",
)

ACTION = _struct(action_type="string", value="string")

META_INSIGHT = _struct(
    date_start="date", campaign_id="string", campaign_name="string", impressions="string",
    clicks="string", spend="string", actions=T.ArrayType(ACTION),
)

ACCOUNT_RECORD = _struct(
    date="date", account_id="string", campaign_id="string", campaign_name="string",
    impressions="long", clicks="long", spend="double", conversions="long",
)

METADATA = _struct(ingested_at="timestamp", extract_run_id="string", source="string")

RAW_GOOGLE = T.StructType(GOOGLE_RECORD.fields + METADATA.fields)
RAW_META = T.StructType(META_RECORD.fields + METADATA.fields)

STG_GOOGLE_COLUMNS = (
    "report_date", "campaign_id", "campaign_name", "impressions", "clicks",
    "conversions", "cost_usd", *METADATA_COLUMNS,
)
STG_META_COLUMNS = (
    "report_date", "campaign_id", "campaign_name", "impressions", "clicks", "spend_usd",
    "likes", "comments", "shares", "video_views", "page_engagement", *METADATA_COLUMNS,
)

UNIFIED = _struct(
    report_date="date", campaign_id="string", campaign_name="string", impressions="long",
    clicks="long", conversions="long", spend="double", likes="long", comments="long",
    shares="long", video_views="long", page_engagement="long", ingested_at="timestamp",
    extract_run_id="string", source="string", platform="string",
)

MART = _struct(
    report_date="date", campaign_id="string", campaign_name="string", platform="string",
    impressions="long", clicks="long", spend="double", conversions="long", likes="long",
    comments="long", shares="long", video_views="long", page_engagement="long", ctr="double",
    cpa="double", roas="double", cpc="double", conversion_rate="double", ingested_at="timestamp",
    extract_run_id="string", source="string", mart_created_at="timestamp",
)

THRESHOLDS = _struct(
    table_name="string", min_daily_records="long", max_daily_records="long",
    max_variance_percent="long", description="string",
)

RUN_SUMMARY = _struct(
    run_id="string", dag_id="string", run_date="date", execution_date="timestamp",
    start_time="timestamp", end_time="timestamp", duration_seconds="long", status="string",
    google_ads_extracted_count="long", google_ads_status="string",
    meta_ads_extracted_count="long", meta_ads_status="string", dbt_docs_generated="boolean",
    error_message="string", error_task="string", created_at="timestamp", updated_at="timestamp",
    dbt_run_status="string", dbt_test_status="string", dbt_test_passed="long",
    dbt_test_failed="long", dbt_test_warnings="long", volume_check_status="string",
    volume_check_tables_checked="long", volume_check_tables_passed="long",
    volume_check_tables_warned="long", volume_check_tables_failed="long",
)
