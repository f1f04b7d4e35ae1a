"""Data-quality checks.

A check yields violating rows or their number; none means PASS. All checks of a
table that look at one row at a time share one aggregation over one scan; a
uniqueness check adds one grouping.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.functions.days import Day, day_before
from adloom.functions.kpis import KPIS, deviates

# --- Fixed values: the columns declared as required, per table -----------------
NOT_NULL = {
    S.RAW_GOOGLE_TABLE: ("date", "campaign_id"),
    S.RAW_META_TABLE: ("date", "campaign_id"),
    S.STG_GOOGLE_TABLE: (
        "report_date", "campaign_id", "impressions", "clicks", "conversions", "cost_usd",
    ),
    S.STG_META_TABLE: ("report_date", "campaign_id", "impressions", "clicks", "spend_usd"),
    S.UNIFIED_TABLE: ("report_date", "campaign_id", "platform", "impressions", "clicks", "spend"),
    S.MART_TABLE: (
        "report_date", "campaign_id", "platform", "impressions", "clicks", "spend",
        "mart_created_at",
    ),
}
ACCEPTED_PLATFORMS = (S.UNIFIED_TABLE, S.MART_TABLE)
UNIQUE_GRAIN = (S.UNIFIED_TABLE, S.MART_TABLE)
KPI_TOLERANCES = {"ctr": 0.0001, "cpc": 0.01, "cpa": 0.01}
METRICS = ("impressions", "clicks", "spend", "conversions")
# ------------------------------------------------------------------------------


# Row predicates. Each is true for a violating row, unknown or false otherwise.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unaccepted(column: str, values: Sequence[str]) -> Column:
    """NULL is not a violation."""
    return ~F.col(column).isin(*values)


def more_clicks_than_impressions() -> Column:
    return F.col("clicks") > F.col("impressions")


def ctr_above_one() -> Column:
    return F.col("ctr") > 1.0


def kpi_deviates() -> Column:
    return reduce(Column.__or__, (deviates(k, t) for k, t in KPI_TOLERANCES.items()))


def any_negative(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, (F.col(c) < 0 for c in columns))


@dataclass(frozen=True)
class RowCheck:
    """A predicate over single rows. ``listed`` names the columns of its report."""

    name: str
    violates: Column
    listed: tuple[str, ...] = ()


MART_TESTS = {
    "clicks_not_exceeding_impressions": (
        more_clicks_than_impressions, ("impressions", "clicks"),
    ),
    "ctr_not_exceeding_100_percent": (ctr_above_one, ("clicks", "impressions", "ctr")),
    "no_negative_metrics": (lambda: any_negative(METRICS), METRICS),
    "kpi_calculations": (kpi_deviates, ()),
}


def mart_test(name: str) -> RowCheck:
    predicate, listed = MART_TESTS[name]
    return RowCheck(name, predicate(), ("report_date", "campaign_id", "platform", *listed))


def violations(mart: DataFrame, check: RowCheck, newest: int | None = None) -> DataFrame:
    """Every violating row; with ``newest``, so many of them from the last days.

    The shorter report is a top-k, not a global row numbering. Ties within a day
    are settled by the rest of the grain, newest version first.
    """
    found = mart.where(check.violates)
    if newest is not None:
        order = [F.desc("report_date"), "platform", "campaign_id", F.desc("ingested_at")]
        found = found.orderBy(*order).limit(newest)
    return found.select(*check.listed)


# Checks over whole tables.


def duplicate_grain(rows: DataFrame, keys: Sequence[str] = S.GRAIN) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Counts are combined per task before the shuffle, so a frequent key arrives
    as one row per task.
    """
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    )


def count_violations(rows: DataFrame, checks: Iterable[RowCheck]) -> DataFrame:
    """(check_name, violations) for any number of row checks, in a single pass."""
    checks = list(checks)
    totals = rows.agg(*(F.count_if(c.violates).alias(f"n{i}") for i, c in enumerate(checks)))
    pairs = F.array(
        *(
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("violations"))
            for i, c in enumerate(checks)
        )
    )
    return totals.select(F.inline(pairs))


def with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS"))


def not_null_checks(table: str) -> list[RowCheck]:
    return [RowCheck(f"not_null_{c}", is_missing(c)) for c in NOT_NULL[table]]


def accepted_platform_check() -> RowCheck:
    return RowCheck("accepted_values_platform", is_unaccepted("platform", S.PLATFORMS))


def row_checks(table: str) -> list[RowCheck]:
    """The declared checks of one table that look at single rows."""
    checks = not_null_checks(table)
    if table in ACCEPTED_PLATFORMS:
        checks.append(accepted_platform_check())
    if table == S.MART_TABLE:
        checks.extend(mart_test(name) for name in MART_TESTS)
    return checks


def grain_check(rows: DataFrame) -> DataFrame:
    """(check_name, violations) of the uniqueness check."""
    return duplicate_grain(rows).agg(
        F.lit("unique_combination_grain").alias("check_name"),
        F.count(F.lit(1)).alias("violations"),
    )


def check_table(table: str, rows: DataFrame) -> DataFrame:
    """All declared checks of one table: (table_name, check_name, violations)."""
    counts = count_violations(rows, row_checks(table))
    if table in UNIQUE_GRAIN:
        counts = counts.unionByName(grain_check(rows))
    return counts.select(F.lit(table).alias("table_name"), "check_name", "violations")


def suite_result(counts: DataFrame) -> DataFrame:
    """Status of each counted check, and how many rows its report would list."""
    capped = F.col("check_name").isin(*MART_TESTS)
    return with_status(counts).withColumn(
        "reported_rows",
        F.when(
            capped, F.least("violations", F.lit(S.VIOLATION_REPORT_ROWS).cast("bigint"))
        ).otherwise(F.col("violations")),
    )


def run_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared check of the given tables, one row each.

    ``violations`` counts them all; ``reported_rows`` is how many the row report
    of the four mart tests would list.
    """
    return suite_result(
        reduce(DataFrame.unionByName, (check_table(t, df) for t, df in tables.items()))
    )


def tally(results: DataFrame) -> DataFrame:
    """Passed, failed and warned checks of a suite result, in one row."""

    def of(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return results.agg(
        F.count(F.lit(1)).alias("total"),
        of("PASS").alias("passed"),
        of("FAIL").alias("failed"),
        of("WARN").alias("warned"),
    )


def accepted_range(mart: DataFrame) -> DataFrame:
    """Negative values per metric and KPI."""
    columns = (*METRICS, *KPIS)
    checks = [RowCheck(f"accepted_range_{c}", F.col(c) < 0) for c in columns]
    return with_status(count_violations(mart, checks))


def recency(mart: DataFrame, as_of: Day = None, days: int = S.RECENCY_DAYS) -> DataFrame:
    """Whether the newest day lies within ``days`` of ``as_of``; an empty table fails."""
    newest = F.max("report_date")
    fresh = newest >= day_before(as_of, days)
    return mart.agg(
        newest.alias("newest_report_date"),
        F.when(fresh, "PASS").otherwise("FAIL").alias("status"),
    )


def not_null_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The required-column checks of the given tables."""
    counts = (
        count_violations(rows, not_null_checks(table)).select(
            F.lit(table).alias("table_name"), "check_name", "violations"
        )
        for table, rows in tables.items()
    )
    return with_status(reduce(DataFrame.unionByName, counts))


def accepted_values_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with an unknown platform, per table."""
    counts = (
        count_violations(rows, [accepted_platform_check()]).select(
            F.lit(table).alias("table_name"), "check_name", "violations"
        )
        for table, rows in tables.items()
    )
    return with_status(reduce(DataFrame.unionByName, counts))
