"""One daily run, from extracted records to the run log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.functions.days import Day, as_day
from adloom.operators import catalog, runlog, volume
from adloom.operators.ledger import Ledger, Watch
from adloom.operators.metadata import new_run_id, stamp
from adloom.operators.writes import (
    append_raw,
    append_run,
    create_table,
    dedup_days,
    refresh_mart,
    write_mart,
)
from adloom.plans import suite
from adloom.plans.mart import build_mart
from adloom.plans.staging import stage_google, stage_meta
from adloom.plans.unified import unify
from adloom.sources.tables import scan_as


@dataclass(frozen=True)
class Layers:
    """Names of the tables of one deployment."""

    schemas: Mapping[str, str]

    @property
    def raw_google(self) -> str:
        return catalog.qualified(S.RAW_GOOGLE_TABLE, "raw", self.schemas)

    @property
    def raw_meta(self) -> str:
        return catalog.qualified(S.RAW_META_TABLE, "raw", self.schemas)

    @property
    def mart(self) -> str:
        return catalog.qualified(S.MART_TABLE, "marts", self.schemas)

    @property
    def ledger(self) -> str:
        return catalog.qualified(S.LEDGER_TABLE, "raw", self.schemas)

    @property
    def run_summary(self) -> str:
        return catalog.qualified(S.RUN_SUMMARY_TABLE, "marts", self.schemas)


def model_frame(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    """One model over the stored raw tables; the mart as stored."""
    if table == S.MART_TABLE:
        return spark.table(layers.mart)
    if table in (S.RAW_GOOGLE_TABLE, S.STG_GOOGLE_TABLE):
        raw = scan_as(spark, layers.raw_google, S.RAW_GOOGLE)
        return raw if table == S.RAW_GOOGLE_TABLE else stage_google(raw)
    raw = scan_as(spark, layers.raw_meta, S.RAW_META)
    return raw if table == S.RAW_META_TABLE else stage_meta(raw)


WATCHED = (
    S.RAW_GOOGLE_TABLE, S.RAW_META_TABLE, S.STG_GOOGLE_TABLE, S.STG_META_TABLE, S.MART_TABLE,
)


def watches(spark: SparkSession, layers: Layers) -> tuple[Watch, Watch, Watch]:
    """What the writers of the raw tables and the mart note in the ledger of a deployment.

    Staging rows are the raw rows with a complete key.
    """
    ledger = Ledger(spark, layers.ledger)
    complete = F.col("date").isNotNull() & F.col("campaign_id").isNotNull()
    return (
        Watch(ledger, {S.RAW_GOOGLE_TABLE: None, S.STG_GOOGLE_TABLE: complete}),
        Watch(ledger, {S.RAW_META_TABLE: None, S.STG_META_TABLE: complete}),
        Watch(ledger, {S.MART_TABLE: None}, "report_date"),
    )


def audit_ledger(spark: SparkSession, layers: Layers) -> DataFrame:
    """The ledger of a deployment beside a recount of its stored tables."""
    stored = {
        name: (spark.table(table), condition, watch.day)
        for watch, table in zip(watches(spark, layers), (layers.raw_google, layers.raw_meta, layers.mart), strict=True)
        for name, condition in watch.tables.items()
    }
    return Ledger(spark, layers.ledger).audit(stored)


def small(results: DataFrame) -> DataFrame:
    """Fix a result of one row per check or table, so that it is computed once."""
    return results.sparkSession.createDataFrame(results.collect(), results.schema)


def run_daily(
    spark: SparkSession,
    google: DataFrame,
    meta: DataFrame,
    layers: Layers,
    as_of: Day,
    run_id: str | None = None,
    ingested_at: dt.datetime | str | None = None,
    started_at: dt.datetime | str | None = None,
    ended_at: dt.datetime | str | None = None,
    since: Day = None,
) -> DataFrame:
    """Ingest both sources, keep the newest versions, build and check the mart.

    Each step ends in a stored table, so a step that fails can be repeated from
    the one before it. Returns the summary row appended to the run log.

    With ``since``, the first day the batches cover, deduplication and the model's
    tests look at the days from there on, and only those days of an existing mart are
    rebuilt; without it everything is. The volume checks read the ledger that the writes keep, not
    the tables; where a deployment has none yet, its tables are counted once. A run that fails is logged with the step and the
    error before the error is raised.
    """
    run = run_id or new_run_id()
    start = started_at or dt.datetime.now(dt.timezone.utc)
    written: dict[str, int] = {}
    step = "start"

    def log(status: str, tests=None, volumes=None, error: str | None = None) -> None:
        def extracted(source: str) -> runlog.SourceResult:
            if source in written:
                return runlog.SourceResult(written[source], "success")
            return runlog.SourceResult()

        summary = runlog.run_summary(
            spark,
            runlog.Run(
                run_id=run,
                dag_id="campaign_daily",
                run_date=as_of,
                execution_date=start,
                status=status,
                google_ads=extracted(S.GOOGLE),
                meta_ads=extracted(S.META),
                error_message=error,
                error_task=step if error else None,
            ),
            tests,
            volumes,
            ended_at,
        )
        append_run(summary, layers.run_summary)

    try:
        # A source that never delivered is an empty table.
        create_table(spark, layers.raw_google, S.RAW_GOOGLE)
        create_table(spark, layers.raw_meta, S.RAW_META)
        of_google, of_meta, of_mart = watches(spark, layers)
        ledger = Ledger(spark, layers.ledger)
        if not ledger.exists():
            for watch, table in ((of_google, layers.raw_google), (of_meta, layers.raw_meta), (of_mart, layers.mart)):
                if spark.catalog.tableExists(table):
                    ledger.settle(watch, spark.table(table))
        for source, records, table, watch in (
            (S.GOOGLE, google, layers.raw_google, of_google),
            (S.META, meta, layers.raw_meta, of_meta),
        ):
            step = f"ingest_{source}"
            written[source] = append_raw(stamp(records, source, run, ingested_at), table, watch=watch)
            step = f"deduplicate_{source}"
            covered = None if since is None else F.col("date") >= as_day(since)
            dedup_days(spark, table, among=covered, watch=watch)

        step = "build_mart"
        union = unify(
            stage_google(scan_as(spark, layers.raw_google, S.RAW_GOOGLE)),
            stage_meta(scan_as(spark, layers.raw_meta, S.RAW_META)),
        )
        if since is not None and spark.catalog.tableExists(layers.mart):
            union = union.where(F.col("report_date") >= as_day(since))
            refresh_mart(build_mart(union, ingested_at), layers.mart, of_mart)
        else:
            write_mart(build_mart(union, ingested_at), layers.mart, of_mart)

        step = "test_models"
        stored = {t: model_frame(spark, layers, t) for t in (S.RAW_GOOGLE_TABLE, S.RAW_META_TABLE, S.MART_TABLE)}
        if since is not None:
            # What lies before was tested when it was written.
            day = {S.MART_TABLE: "report_date"}
            stored = {t: f.where(F.col(day.get(t, "date")) >= as_day(since)) for t, f in stored.items()}
        tests = small(suite.run_model_suite(*stored.values()))
        step = "check_volumes"
        watched = {t: lambda t=t: model_frame(spark, layers, t) for t in WATCHED}
        counts = volume.ledger_counts(ledger, watched, as_of)
        volumes = small(volume.evaluate(counts, volume.default_thresholds(spark)))
    except Exception as error:
        log("failed", error=str(error))
        raise
    log("success", tests, volumes)
    return spark.table(layers.run_summary).where(F.col("run_id") == run)
