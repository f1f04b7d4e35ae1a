"""Run summaries: one row per daily run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.functions.days import Day, as_day, as_instant, elapsed_seconds
from adloom.operators.quality import tally
from adloom.operators.volume import summarize

RECENT_RUN_COLUMNS = (
    "run_id", "dag_id", "run_date", "execution_date", "duration_seconds", "status",
    "google_ads_status", "meta_ads_status", "dbt_test_status", "volume_check_status",
)


@dataclass(frozen=True)
class SourceResult:
    """What one extraction reported."""

    record_count: int = 0
    status: str = "unknown"


@dataclass(frozen=True)
class Run:
    run_id: str
    dag_id: str
    run_date: Day
    execution_date: dt.datetime | str
    status: str
    google_ads: SourceResult = SourceResult()
    meta_ads: SourceResult = SourceResult()
    docs_generated: bool = False
    error_message: str | None = None
    error_task: str | None = None


def _test_fields(spark: SparkSession, results: DataFrame | None) -> DataFrame:
    """Roll-up of a suite result; without one the tests did not run."""
    if results is None:
        return spark.range(1).select(
            F.lit("not_run").alias("dbt_run_status"),
            F.lit("not_run").alias("dbt_test_status"),
            *(
                F.lit(0).cast("bigint").alias(f"dbt_test_{name}")
                for name in ("passed", "failed", "warnings")
            ),
        )
    ok = F.col("failed") == 0
    return tally(results).select(
        F.when(ok, "success").otherwise("failed").alias("dbt_run_status"),
        F.when(ok, "success").otherwise("failed").alias("dbt_test_status"),
        F.col("passed").alias("dbt_test_passed"),
        F.col("failed").alias("dbt_test_failed"),
        F.col("warned").alias("dbt_test_warnings"),
    )


def _volume_fields(spark: SparkSession, checks: DataFrame | None) -> DataFrame:
    """Roll-up of the volume checks; without any they did not run."""
    names = {"checked": "total_tables", "passed": "passed", "warned": "warned", "failed": "failed"}
    if checks is None:
        return spark.range(1).select(
            F.lit("not_run").alias("volume_check_status"),
            *(F.lit(0).cast("bigint").alias(f"volume_check_tables_{n}") for n in names),
        )
    return summarize(checks).select(
        F.col("overall_status").alias("volume_check_status"),
        *(F.col(c).alias(f"volume_check_tables_{n}") for n, c in names.items()),
    )


def run_summary(
    spark: SparkSession,
    run: Run,
    test_results: DataFrame | None = None,
    volume_results: DataFrame | None = None,
    end_time: dt.datetime | str | None = None,
) -> DataFrame:
    """The summary row of a run; the two roll-ups are one-row aggregates each."""
    start, end = as_instant(run.execution_date), as_instant(end_time)
    fields: dict[str, Column] = {
        "run_id": F.lit(run.run_id),
        "dag_id": F.lit(run.dag_id),
        "run_date": as_day(run.run_date),
        "execution_date": start,
        "start_time": start,
        "end_time": end,
        "duration_seconds": elapsed_seconds(start, end),
        "status": F.lit(run.status),
        "google_ads_extracted_count": F.lit(run.google_ads.record_count),
        "google_ads_status": F.lit(run.google_ads.status),
        "meta_ads_extracted_count": F.lit(run.meta_ads.record_count),
        "meta_ads_status": F.lit(run.meta_ads.status),
        "dbt_docs_generated": F.lit(run.docs_generated),
        "error_message": F.lit(run.error_message),
        "error_task": F.lit(run.error_task),
        "created_at": end,
        "updated_at": end,
    }
    # Each roll-up is one row with columns of its own: stacked and folded to one.
    tests = _test_fields(spark, test_results)
    volumes = _volume_fields(spark, volume_results)
    stacked = tests.unionByName(volumes, allowMissingColumns=True)
    rolled_up = stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
    return rolled_up.select(
        *(
            (fields[f.name] if f.name in fields else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in S.RUN_SUMMARY.fields
        )
    )


def recent_runs(log: DataFrame, limit: int = 10) -> DataFrame:
    """The newest runs first."""
    return log.orderBy(F.desc("execution_date"), "run_id").limit(limit).select(*RECENT_RUN_COLUMNS)
