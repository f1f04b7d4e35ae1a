"""The declared checks and the volume counts over the whole model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.functions.days import Day, day_before, on_day
from adloom.operators.quality import check_table, grain_check, row_checks, suite_result
from adloom.operators.volume import day_counts
from adloom.plans.staging import stage_google, stage_meta
from adloom.plans.unified import unify


def _checks_from_raw(
    raw: DataFrame, raw_table: str, stg_table: str, platform: str, spend: str
) -> DataFrame:
    """Row checks of a raw table and of the two views over it, in one scan.

    Staging and the unified branch are the raw rows with a complete key under
    other column names, so their checks are the same predicates within that
    scope.
    """
    named = raw.withColumns(
        {
            "report_date": F.col("date"),
            "spend": F.col(spend),
            "platform": F.lit(platform),
        }
    )
    in_views = F.col("date").isNotNull() & F.col("campaign_id").isNotNull()
    scopes = {raw_table: F.lit(True), stg_table: in_views, S.UNIFIED_TABLE: in_views}
    scoped = [
        (table, check.name, scope & check.violates)
        for table, scope in scopes.items()
        for check in row_checks(table)
    ]
    totals = named.agg(*(F.count_if(hit).alias(f"n{i}") for i, (_, _, hit) in enumerate(scoped)))
    entries = F.array(
        *(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("check_name"),
                F.col(f"n{i}").alias("violations"),
            )
            for i, (table, name, _) in enumerate(scoped)
        )
    )
    return totals.select(F.inline(entries))


def run_model_suite(raw_google: DataFrame, raw_meta: DataFrame, mart: DataFrame) -> DataFrame:
    """The result of ``run_suite`` over the whole model, with fewer scans.

    Each raw table is read once for all row checks of raw, staging and unified
    rows, and once more, for its key columns, by the uniqueness check. The mart
    is checked as it is stored.
    """
    of_sources = _checks_from_raw(
        raw_google, S.RAW_GOOGLE_TABLE, S.STG_GOOGLE_TABLE, S.GOOGLE, "cost_usd"
    ).unionByName(
        _checks_from_raw(raw_meta, S.RAW_META_TABLE, S.STG_META_TABLE, S.META, "spend_usd")
    )
    per_check = of_sources.groupBy("table_name", "check_name").agg(
        F.sum("violations").alias("violations")
    )
    union = unify(stage_google(raw_google), stage_meta(raw_meta))
    unified_grain = grain_check(union).select(
        F.lit(S.UNIFIED_TABLE).alias("table_name"), "check_name", "violations"
    )
    return suite_result(
        per_check.unionByName(unified_grain).unionByName(check_table(S.MART_TABLE, mart))
    )


def model_day_counts(
    raw_google: DataFrame, raw_meta: DataFrame, mart: DataFrame, as_of: Day = None
) -> DataFrame:
    """The result of ``counts_by_table`` over the model, with one scan per stored table.

    Staging rows are the raw rows with a complete key, so both are counted together.
    """
    today, yesterday = on_day("ingested_at", as_of), on_day("ingested_at", day_before(as_of))
    complete = F.col("date").isNotNull() & F.col("campaign_id").isNotNull()

    def entry(table: str, today_count: Column, yesterday_count: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"),
            today_count.alias("today_count"),
            yesterday_count.alias("yesterday_count"),
            F.lit(None).cast("string").alias("error"),
        )

    def of_source(raw: DataFrame, raw_table: str, stg_table: str) -> DataFrame:
        counts = raw.where(today | yesterday).agg(
            F.count_if(today).alias("raw_today"),
            F.count_if(yesterday).alias("raw_yesterday"),
            F.count_if(today & complete).alias("stg_today"),
            F.count_if(yesterday & complete).alias("stg_yesterday"),
        )
        entries = F.array(
            entry(raw_table, F.col("raw_today"), F.col("raw_yesterday")),
            entry(stg_table, F.col("stg_today"), F.col("stg_yesterday")),
        )
        return counts.select(F.inline(entries))

    of_mart = day_counts(mart, as_of).select(
        F.inline(F.array(entry(S.MART_TABLE, F.col("today_count"), F.col("yesterday_count"))))
    )
    return (
        of_source(raw_google, S.RAW_GOOGLE_TABLE, S.STG_GOOGLE_TABLE)
        .unionByName(of_source(raw_meta, S.RAW_META_TABLE, S.STG_META_TABLE))
        .unionByName(of_mart)
    )
