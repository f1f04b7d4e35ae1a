"""Day-over-day volume checks by ingestion day."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom import schemas as S
from adloom.functions.conversion import present_only
from adloom.functions.days import Day, as_day, day_before, on_day
from adloom.functions.rounding import round_binary
from adloom.operators.calendar import scaffold
from adloom.operators.ledger import Ledger

Tables = Mapping[str, "DataFrame | Callable[[], DataFrame]"]

# --- Fixed values: texts of the report -----------------------------------------
ISSUE_BELOW = "Record count (%d) below minimum threshold (%d)"
ISSUE_ABOVE = "Record count (%d) exceeds maximum threshold (%d)"
ISSUE_VARIANCE = "Day-over-day variance (%.1f%%) exceeds threshold (%d%%)"
ERROR_BELOW = "%s: Below minimum threshold (%d/%d)"
ERROR_ABOVE = "%s: Exceeds maximum threshold (%d/%d)"
WARNING_VARIANCE = "%s: High variance (%.1f%%, yesterday: %d)"
# ------------------------------------------------------------------------------


def default_thresholds(spark: SparkSession, layers: Mapping[str, str] | None = None) -> DataFrame:
    """The threshold table; with ``layers`` names are qualified by their schema."""
    rows = [
        (f"{layers[layer]}.{table}" if layers else table, *limits)
        for layer, table, *limits in S.VOLUME_THRESHOLDS
    ]
    return spark.createDataFrame(rows, S.THRESHOLDS)


def day_counts(rows: DataFrame, as_of: Day = None) -> DataFrame:
    """Rows ingested on ``as_of`` and on the day before, from one pruned scan."""
    today, yesterday = on_day("ingested_at", as_of), on_day("ingested_at", day_before(as_of))
    return rows.where(today | yesterday).agg(
        F.count_if(today).alias("today_count"), F.count_if(yesterday).alias("yesterday_count")
    )


_COUNTS = "table_name string, today_count bigint, yesterday_count bigint, error string"


def counts_by_table(
    spark: SparkSession, tables: Tables, as_of: Day = None, isolate: bool = True
) -> DataFrame:
    """One row per table; a table that cannot be resolved yields its error instead.

    Give a table as a function where looking it up may fail. Each table is counted
    by itself, so that files that turn out unreadable become an error of their
    table as well; without ``isolate`` all are counted in one job.
    """

    def failed(name: str, error: Exception) -> DataFrame:
        return spark.createDataFrame([(name, None, None, str(error))], _COUNTS)

    def counted(name: str) -> DataFrame:
        try:
            frame = tables[name]
            counts = day_counts(frame() if callable(frame) else frame, as_of).select(
                F.lit(name).alias("table_name"),
                "today_count",
                "yesterday_count",
                F.lit(None).cast("string").alias("error"),
            )
            if isolate:
                return spark.createDataFrame(counts.collect(), _COUNTS)
            return counts
        except (PySparkException, Py4JError) as error:
            return failed(name, error)

    return reduce(DataFrame.unionByName, (counted(name) for name in tables))


def ledger_counts(
    ledger: Ledger, tables: Mapping[str, Callable[[], DataFrame]], as_of: Day = None
) -> DataFrame:
    """The result of ``counts_by_table`` from a ledger: the tables themselves are only looked up.

    A table that can't be looked up yields its error.
    """
    errors = {}
    for name, frame in tables.items():
        try:
            frame()
        except (PySparkException, Py4JError) as error:
            errors[name] = str(error)
    counts = ledger.day_counts([name for name in tables if name not in errors], as_of)
    if not errors:
        return counts
    failed = [(name, None, None, error) for name, error in errors.items()]
    return counts.unionByName(ledger.spark.createDataFrame(failed, _COUNTS))


def variance_percent(current: Column, previous: Column) -> Column:
    """Absolute change against the day before; zero where that day had no rows."""
    change = F.abs(current - previous) / F.nullif(previous, F.lit(0)) * 100
    return F.coalesce(F.when(previous > 0, change), F.lit(0.0))


def evaluate(counts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Check each table of the threshold list against its counts.

    The variance rule is applied last and overrides a failed minimum or maximum;
    ``max_severity`` keeps the failure visible. Both inputs have one row per
    table, whatever the tables hold.
    """
    today, yesterday = F.col("today_count"), F.col("yesterday_count")
    low, high = F.col("min_daily_records"), F.col("max_daily_records")
    change, allowed = F.col("_change"), F.col("max_variance_percent")
    shown_change = round_binary(change, 1)
    failed = F.col("error").isNotNull()
    below, above, varied = today < low, today > high, change > allowed

    def text(condition: Column, template: str, *values: Column) -> Column:
        return F.when(condition & ~failed, F.format_string(template, *values))

    checked = (
        thresholds.join(counts, "table_name", "left")
        .withColumns(
            {
                "today_count": F.when(failed, None).otherwise(F.coalesce(today, F.lit(0))),
                "yesterday_count": F.when(failed, None).otherwise(F.coalesce(yesterday, F.lit(0))),
            }
        )
        .withColumn("_change", F.when(~failed, variance_percent(today, yesterday)))
    )
    name = F.col("table_name")
    return checked.select(
        "table_name",
        "description",
        "today_count",
        "yesterday_count",
        round_binary(change, 2).alias("variance_percent"),
        F.when(failed, "ERROR")
        .when(varied, "WARN")
        .when(below | above, "FAIL")
        .otherwise("PASS")
        .alias("status"),
        F.when(failed, "ERROR")
        .when(below | above, "FAIL")
        .when(varied, "WARN")
        .otherwise("PASS")
        .alias("max_severity"),
        present_only(
            text(below, ISSUE_BELOW, today, low),
            text(above, ISSUE_ABOVE, today, high),
            text(varied, ISSUE_VARIANCE, shown_change, allowed),
        ).alias("issues"),
        present_only(text(varied, WARNING_VARIANCE, name, shown_change, yesterday)).alias(
            "warnings"
        ),
        present_only(
            text(below, ERROR_BELOW, name, today, low),
            text(above, ERROR_ABOVE, name, today, high),
            F.when(failed, F.concat_ws(": ", name, F.col("error"))),
        ).alias("errors"),
        "error",
    )


def volume_checks(
    spark: SparkSession,
    tables: Tables,
    as_of: Day = None,
    thresholds: DataFrame | None = None,
    isolate: bool = True,
) -> DataFrame:
    limits = default_thresholds(spark) if thresholds is None else thresholds
    return evaluate(counts_by_table(spark, tables, as_of, isolate), limits)


def summarize(checks: DataFrame) -> DataFrame:
    """Tables by status, and PASS overall where none failed or could not be read."""

    def of(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return checks.agg(
        F.count(F.lit(1)).alias("total_tables"),
        of("PASS").alias("passed"),
        of("WARN").alias("warned"),
        of("FAIL").alias("failed"),
        of("ERROR").alias("errored"),
    ).withColumn(
        "overall_status",
        F.when((F.col("failed") == 0) & (F.col("errored") == 0), "PASS").otherwise("FAIL"),
    )


def report(checks: DataFrame) -> DataFrame:
    """The report as rows: a summary line, one line per table, warnings and errors."""
    summary = summarize(checks).select(
        F.lit("summary").alias("section"),
        F.lit(None).cast("string").alias("table_name"),
        F.col("overall_status").alias("status"),
        F.format_string(
            "%d PASS, %d WARN, %d FAIL, %d ERROR", "passed", "warned", "failed", "errored"
        ).alias("result"),
        F.lit("").alias("issues"),
    )
    counts = F.format_string(
        "Today: %d | Yesterday: %d | Variance: %s%%",
        "today_count", "yesterday_count", F.col("variance_percent").cast("string"),
    )

    def line(section: str, result: Column, status: Column, issues: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.col("table_name"),
            status.alias("status"),
            result.alias("result"),
            issues.alias("issues"),
        )

    def messages(section: str, column: str) -> Column:
        nothing = F.lit(None).cast("string")
        return F.transform(column, lambda text: line(section, text, nothing, F.lit("")))

    of_table = line(
        "table",
        F.when(F.col("error").isNull(), counts).otherwise(
            F.concat(F.lit("Error: "), F.col("error"))
        ),
        F.col("status"),
        F.concat_ws("; ", "issues"),
    )
    lines = F.concat(F.array(of_table), messages("warning", "warnings"), messages("error", "errors"))
    return summary.unionByName(checks.select(F.inline(lines)))


def volume_history(rows: DataFrame, start: Day, end: Day) -> DataFrame:
    """Rows per ingestion day and platform with the change against the day before.

    Counted per day first, so a platform then gathers one entry per day. Days
    without rows are filled in from the calendar, so that the previous row is
    always the previous day; the window runs over one row per platform and day.
    """
    instant = F.col("ingested_at")
    in_range = (instant >= as_day(start).cast("timestamp")) & (
        instant < F.date_add(as_day(end), 1).cast("timestamp")
    )
    daily = (
        rows.where(in_range)
        .groupBy("source", F.to_date("ingested_at").alias("day"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return dense_history(daily, "source", start, end)


def ledger_history(ledger: Ledger, start: Day, end: Day) -> DataFrame:
    """Rows per ingestion day and table from a ledger, with the change against the day before."""
    known = F.col("day").between(as_day(start), as_day(end))
    return dense_history(ledger.daily().where(known), "table_name", start, end)


def dense_history(daily: DataFrame, name: str, start: Day, end: Day) -> DataFrame:
    """(name, day, row_count) filled in from the calendar, with the change against the day before."""
    by_name = daily.groupBy(name).agg(
        F.map_from_entries(F.collect_list(F.struct("day", "row_count"))).alias("counts")
    )
    count = F.coalesce(F.try_element_at("counts", F.col("day")), F.lit(0))
    dense = scaffold(by_name, start, end, "day").select(name, "day", count.alias("row_count"))
    previous = F.lag("row_count").over(Window.partitionBy(name).orderBy("day"))
    return dense.withColumn("previous_count", previous).withColumn(
        "variance_percent",
        round_binary(variance_percent(F.col("row_count"), F.col("previous_count")), 2),
    )
