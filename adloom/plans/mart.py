"""The campaign mart: unified rows with a complete key, plus the KPIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.functions.days import as_instant
from adloom.functions.kpis import KPIS, kpi
from adloom.plans.staging import stage_google, stage_meta
from adloom.plans.unified import unify


def build_mart(
    unified: DataFrame, created_at: str | dt.datetime | Column | None = None
) -> DataFrame:
    """Projection only: both key filters and the column list reach the scans."""
    complete = unified.where(
        F.col("report_date").isNotNull()
        & F.col("campaign_id").isNotNull()
        & F.col("platform").isNotNull()
    )

    def column(name: str) -> Column:
        if name == "mart_created_at":
            return as_instant(created_at).alias(name)
        return kpi(name) if name in KPIS else F.col(name)

    return complete.select(*(column(name) for name in S.MART.names))


def mart_from_raw(
    raw_google: DataFrame,
    raw_meta: DataFrame,
    created_at: str | dt.datetime | Column | None = None,
) -> DataFrame:
    """Raw tables in the state the mart expects (one version per key) to the mart."""
    return build_mart(unify(stage_google(raw_google), stage_meta(raw_meta)), created_at)


def register_views(spark: SparkSession, raw_google: DataFrame, raw_meta: DataFrame) -> None:
    """Every model as a temporary view, recomputed on read, for use from SQL."""
    stg_google, stg_meta = stage_google(raw_google), stage_meta(raw_meta)
    unified = unify(stg_google, stg_meta)
    for name, frame in {
        S.STG_GOOGLE_TABLE: stg_google,
        S.STG_META_TABLE: stg_meta,
        S.UNIFIED_TABLE: unified,
        S.MART_TABLE: build_mart(unified),
    }.items():
        frame.createOrReplaceTempView(name)
