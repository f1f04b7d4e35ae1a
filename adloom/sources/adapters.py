"""Campaign-shaped inputs derived from the given tables.

``lineitem`` plays the Google side and ``events`` the Meta side, in the shape of
an append-only raw zone: up to three extraction runs per campaign-day. Money is
added exactly, so that the values do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.functions.aggregates import exact_sum, exact_total

FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"
DAYS = 30
RUNS = 3


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tally(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


def _metadata(source: str) -> list[Column]:
    """Fixed, so that every run over the same tables gives the same rows."""
    return [
        (
            F.date_add("date", 1).cast("timestamp") + F.make_dt_interval(hours=F.col("run"))
        ).alias("ingested_at"),
        F.concat(F.lit("run_"), F.col("run")).alias("extract_run_id"),
        F.lit(source).alias("source"),
    ]


def raw_google(spark: SparkSession, folder: str) -> DataFrame:
    offset = F.pmod(F.date_diff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")), F.lit(DAYS))
    cost = exact_total(F.col("l_quantity") * F.col("l_tax"))
    return (
        _table(spark, folder, "lineitem")
        .groupBy(
            F.date_add(F.lit(FIRST_DAY).cast("date"), offset).alias("date"),
            "l_suppkey",
            F.pmod("l_orderkey", F.lit(RUNS)).cast("int").alias("run"),
        )
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("impressions"),
            F.sum(F.col("l_linenumber").cast("bigint")).alias("clicks"),
            F.count_if(F.col("l_returnflag") == "N").alias("conversions"),
            F.round(cost, 2).cast("double").alias("cost_usd"),
        )
        .select(
            "date",
            F.concat(F.lit("camp_"), F.col("l_suppkey")).alias("campaign_id"),
            F.concat(F.lit("Campaign "), F.col("l_suppkey")).alias("campaign_name"),
            "impressions",
            "clicks",
            "conversions",
            "cost_usd",
            *_metadata(S.GOOGLE),
        )
    )


def raw_meta(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "events")
        .groupBy(
            F.to_date("ts").alias("date"),
            F.col("user_id").alias("campaign_id"),
            F.pmod("event_id", F.lit(RUNS)).cast("int").alias("run"),
        )
        .agg(
            (_tally("view") * 20).alias("impressions"),
            _tally("click").alias("clicks"),
            exact_sum("value").alias("spend_usd"),
            _tally("signup").alias("likes"),
            _tally("error").alias("comments"),
            _tally("purchase").alias("shares"),
            _tally("view").alias("video_views"),
            F.count(F.lit(1)).alias("page_engagement"),
        )
        .select(
            "date",
            "campaign_id",
            F.concat(F.lit("Meta "), F.col("campaign_id")).alias("campaign_name"),
            "impressions",
            "clicks",
            "spend_usd",
            "likes",
            "comments",
            "shares",
            "video_views",
            "page_engagement",
            *_metadata(S.META),
        )
    )


def meta_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Nested payloads: one action entry per event type seen, none for clicks alone."""

    def entry(action_type: str, total: str) -> Column:
        return F.when(
            F.col(total) > 0,
            F.struct(
                F.lit(action_type).alias("action_type"),
                F.col(total).cast("string").alias("value"),
            ),
        )

    actions = F.filter(
        F.array(
            entry("post_reaction", "signups"),
            entry("comment", "errors"),
            entry("post", "purchases"),
            entry("video_view", "views"),
        ),
        lambda a: a.isNotNull(),
    )
    return (
        _table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("date_start"), "user_id")
        .agg(
            _tally("view").alias("views"),
            _tally("click").alias("clicks_seen"),
            _tally("signup").alias("signups"),
            _tally("error").alias("errors"),
            _tally("purchase").alias("purchases"),
            exact_sum("value").alias("spent"),
        )
        .select(
            "date_start",
            F.col("user_id").cast("string").alias("campaign_id"),
            F.concat(F.lit("Meta "), F.col("user_id")).alias("campaign_name"),
            F.when(F.col("views") > 0, (F.col("views") * 20).cast("string")).alias("impressions"),
            F.when(F.col("clicks_seen") > 0, F.col("clicks_seen").cast("string")).alias("clicks"),
            F.when(F.col("spent") != 0, F.col("spent").cast("string")).alias("spend"),
            F.when(F.size(actions) > 0, actions).alias("actions"),
        )
    )
