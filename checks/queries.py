"""One query per operator, over whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom import sources
from adloom.functions import conversion, days, kpis
from adloom.operators import buckets, calendar, catalog, digests, metadata, profile, quality, rollup, runlog, volume, writes
from adloom.operators.latest import (
    latest_raw,
    latest_unified,
    late_window,
    restate,
)
from adloom.operators.ledger import Ledger
from adloom.plans import analysis, daily, mart, staging, suite, unified
from adloom.session import configure, shared_folder
from adloom.sources import adapters, widening
from adloom.sources.insights import flatten_insights
from adloom.sources.tables import scan, scan_as
from adloom.streaming import ingest, newest
from checks.oracle import BROKEN_LIMITS

AS_OF = adapters.LAST_DAY
CREATED_AT = "2024-01-31T00:00:00+00:00"
RANGE = ("2024-01-08", "2024-01-21")
ALL_DAYS = (adapters.FIRST_DAY, adapters.LAST_DAY)
INGESTED_AT = "2024-02-01T06:00:00+00:00"
LATER = "2024-02-02T06:00:00+00:00"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

Query = Callable[[SparkSession, str], DataFrame]


# Frames shared by many queries


def raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return adapters.raw_google(spark, sf), adapters.raw_meta(spark, sf)


def latest(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    google, meta = raw(spark, sf)
    return latest_raw(google), latest_raw(meta)


def all_runs_unified(spark: SparkSession, sf: str) -> DataFrame:
    google, meta = raw(spark, sf)
    return unified.unify(staging.stage_google(google), staging.stage_meta(meta))


def the_unified(spark: SparkSession, sf: str) -> DataFrame:
    google, meta = latest(spark, sf)
    return unified.unify(staging.stage_google(google), staging.stage_meta(meta))


def the_mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart.build_mart(the_unified(spark, sf), CREATED_AT)


def all_runs_mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart.build_mart(all_runs_unified(spark, sf), CREATED_AT)


def model(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    google, meta = latest(spark, sf)
    stg_google, stg_meta = staging.stage_google(google), staging.stage_meta(meta)
    union = unified.unify(stg_google, stg_meta)
    return {
        S.RAW_GOOGLE_TABLE: google,
        S.RAW_META_TABLE: meta,
        S.STG_GOOGLE_TABLE: stg_google,
        S.STG_META_TABLE: stg_meta,
        S.UNIFIED_TABLE: union,
        S.MART_TABLE: mart.build_mart(union, CREATED_AT),
    }


def watched(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: f for t, f in model(spark, sf).items() if t != S.UNIFIED_TABLE}


def over_mart(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(the_mart(spark, sf))


def joined_texts(checks: DataFrame) -> DataFrame:
    lists = ("issues", "warnings", "errors")
    return checks.withColumns({c: F.concat_ws("; ", c) for c in lists})


def land(rows: DataFrame, folder: str, day_column: str) -> str:
    """Landed files: JSON lines in one folder per day."""
    rows.hint("rebalance", day_column).write.partitionBy(day_column).json(folder)
    return folder


def private_layers(spark: SparkSession) -> daily.Layers:
    """Fresh schemas for one call, stored in the shared folder."""
    suffix = uuid.uuid4().hex[:12]
    names = {layer: f"{name}_{suffix}" for layer, name in catalog.LAYERS.items()}
    catalog.create_namespaces(spark, names, shared_folder(spark, "schemas"))
    return daily.Layers(names)


# Sources


def google_extract(spark: SparkSession, sf: str) -> DataFrame:
    records = adapters.raw_google(spark, sf).drop(*S.METADATA_COLUMNS)
    landed = land(records, shared_folder(spark, "google-landing"), "date")
    return sources.GOOGLE_FLAT.read(spark, landed, *RANGE)


def meta_extract(spark: SparkSession, sf: str) -> DataFrame:
    records = adapters.raw_meta(spark, sf).drop(*S.METADATA_COLUMNS)
    landed = land(records, shared_folder(spark, "meta-landing"), "date")
    return sources.META_FLAT.read(spark, landed, *RANGE)


def meta_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_insights(adapters.meta_insights(spark, sf))


def meta_insights_extract(spark: SparkSession, sf: str) -> DataFrame:
    landed = land(
        adapters.meta_insights(spark, sf), shared_folder(spark, "insight-landing"), "date_start"
    )
    return sources.META_NESTED.read(spark, landed, *RANGE)


def account_records(spark: SparkSession, sf: str) -> DataFrame:
    google = adapters.raw_google(spark, sf)
    by_account = google.select(
        "date",
        F.concat(F.lit("acc_"), "extract_run_id").alias("account_id"),
        "campaign_id",
        "campaign_name",
        "impressions",
        "clicks",
        F.col("cost_usd").alias("spend"),
        "conversions",
    )
    return sources.GOOGLE_SAMPLE.to_records(by_account)


def calendar_scaffold(spark: SparkSession, sf: str) -> DataFrame:
    campaigns = adapters.raw_google(spark, sf).select("campaign_id", "campaign_name").distinct()
    return calendar.scaffold(campaigns, *ALL_DAYS)


def missing_campaign_days(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.missing_campaign_days(adapters.raw_meta(spark, sf), *ALL_DAYS)


def missing_from_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer is a campaign that should deliver on every day; few are suppliers too."""
    campaigns = scan(spark, f"{sf}/customer.parquet").select(
        F.concat(F.lit("camp_"), "c_custkey").alias("campaign_id")
    )
    return calendar.missing_from_dimension(campaigns, adapters.raw_google(spark, sf), *ALL_DAYS)


# Raw zone


def ingestion_metadata(spark: SparkSession, sf: str) -> DataFrame:
    records = adapters.raw_google(spark, sf).drop(*S.METADATA_COLUMNS)
    return metadata.stamp(records, S.GOOGLE, "run_fixed", INGESTED_AT)


def raw_append(spark: SparkSession, sf: str) -> DataFrame:
    google = adapters.raw_google(spark, sf)
    folder = shared_folder(spark, "raw-append")
    newest = F.col("extract_run_id") == "run_2"
    writes.append_raw(google.where(~newest), folder)
    writes.append_raw(google.where(newest), folder)
    return scan_as(spark, folder, S.RAW_GOOGLE)


def raw_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The whole period in one batch: landed payloads to the raw zone."""
    landed = land(
        adapters.meta_insights(spark, sf), shared_folder(spark, "insight-landing"), "date_start"
    )
    records = sources.META_NESTED.read(spark, landed, *ALL_DAYS)
    folder = shared_folder(spark, "raw-backfill")
    writes.append_raw(metadata.stamp(records, S.META, "backfill", INGESTED_AT), folder)
    return scan_as(spark, folder, S.RAW_META)


def _two_arrivals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    google = adapters.raw_google(spark, sf)
    late = F.col("extract_run_id") == "run_2"
    return google.where(~late), google.where(late)


def late_restatement(spark: SparkSession, sf: str) -> DataFrame:
    return restate(*_two_arrivals(spark, sf), AS_OF)


def raw_replace_days(spark: SparkSession, sf: str) -> DataFrame:
    stored, late = _two_arrivals(spark, sf)
    folder = shared_folder(spark, "raw-replace")
    writes.append_raw(stored, folder)
    fresh = restate(scan_as(spark, folder, S.RAW_GOOGLE), late, AS_OF)
    writes.replace_partitions(fresh, folder)
    return scan_as(spark, folder, S.RAW_GOOGLE)


def raw_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    table = private_layers(spark).raw_google
    writes.append_raw(adapters.raw_google(spark, sf), table)
    writes.dedup_days(spark, table)
    return scan_as(spark, table, S.RAW_GOOGLE)


def ingestion_profile(spark: SparkSession, sf: str) -> DataFrame:
    google, meta = raw(spark, sf)
    profiles = (
        profile.ingestion_profile(rows, spend).withColumn("source", F.lit(source))
        for source, rows, spend in ((S.GOOGLE, google, "cost_usd"), (S.META, meta, "spend_usd"))
    )
    return reduce(DataFrame.unionByName, profiles)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Landed payloads arrive in two parts; the stream is run after each."""
    payload = adapters.meta_insights(spark, sf)
    landing = shared_folder(spark, "stream-landing")
    target = shared_folder(spark, "stream-raw")
    checkpoint = shared_folder(spark, "stream-checkpoint")
    first_half = F.col("date_start") < RANGE[1]
    for part in (payload.where(first_half), payload.where(~first_half)):
        part.hint("rebalance", "date_start").write.mode("append").partitionBy("date_start").json(
            landing
        )
        ingest.ingest_landed(
            spark,
            sources.META_NESTED,
            landing,
            target,
            checkpoint,
            "meta",
            ingested_at=lambda batch: INGESTED_AT,
        )
    return scan_as(spark, target, S.RAW_META).drop("extract_run_id", "conversions")


def stream_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The raw rows arrive run by run; the newest of each campaign-day, some days compacted."""
    landing, target = shared_folder(spark, "newest-landing"), shared_folder(spark, "newest-raw")
    checkpoint = shared_folder(spark, "newest-checkpoint")
    raw_meta = adapters.raw_meta(spark, sf)
    for run in ("run_0", "run_2", "run_1"):
        part = raw_meta.where(F.col("extract_run_id") == run)
        part.hint("rebalance", "date").write.mode("append").partitionBy("date").json(landing)
        rows = spark.readStream.schema(S.RAW_META).option("maxFilesPerTrigger", "1000").json(landing)
        newest.ingest_newest(rows, target, checkpoint)
    newest.compact_changes(spark, target, S.RAW_META, F.col("date") < RANGE[0])
    return newest.newest_rows(spark, target, S.RAW_META).drop("conversions")


def restated_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals in a bucketed table, its late days replaced by their newest rows in place."""
    table = private_layers(spark).raw_google
    for part in _two_arrivals(spark, sf):
        buckets.append_bucketed(part, table, 8)
    buckets.restate_bucketed(spark, table, AS_OF)
    return scan_as(spark, table, S.RAW_GOOGLE)


def missing_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps of the campaigns as intervals."""
    return calendar.missing_runs(adapters.raw_meta(spark, sf), *ALL_DAYS)


def missing_days_unrolled(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.unrolled(missing_runs(spark, sf))


# Models


def typed_staging(spark: SparkSession, sf: str) -> DataFrame:
    google = adapters.raw_google(spark, sf)
    as_text = google.select(*(F.col(c).cast("string").alias(c) for c in S.GOOGLE_RECORD.names))
    return staging.typed(as_text, S.GOOGLE_RECORD)


def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = staging.with_quality_flags(all_runs_unified(spark, sf))
    return flagged.select(*S.GRAIN, "extract_run_id", "impressions", "clicks", "is_invalid_clicks")


def mart_table(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "mart")
    writes.write_mart(the_mart(spark, sf), folder)
    return scan_as(spark, folder, S.MART)


def mart_swapped(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of all runs, then in its place the mart of the newest ones."""
    table = private_layers(spark).mart
    writes.write_mart(all_runs_mart(spark, sf), table)
    writes.write_mart(the_mart(spark, sf), table)
    return scan_as(spark, table, S.MART)


def mart_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of all runs, with the late-data days replaced by their newest state."""
    folder = shared_folder(spark, "mart")
    writes.write_mart(all_runs_mart(spark, sf), folder)
    writes.refresh_mart(late_window(the_mart(spark, sf), AS_OF, "report_date"), folder)
    return scan_as(spark, folder, S.MART)


def kpi_targets(spark: SparkSession, sf: str) -> DataFrame:
    return the_mart(spark, sf).select(*S.GRAIN, *kpis.target_flags())


def mart_by_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The models as views, queried in SQL."""
    mart.register_views(spark, *latest(spark, sf))
    return spark.sql(
        f"""
        select report_date, platform, count(*) as campaigns, sum(impressions) as impressions,
               sum(clicks) as clicks, count(ctr) as with_ctr, max(cpc) as max_cpc
        from {S.MART_TABLE}
        where report_date >= date'{AS_OF}' - 7
        group by report_date, platform
        """
    )


def ledger_layers(spark: SparkSession, sf: str) -> daily.Layers:
    """Stored tables after appends, deduplication, a build and a refresh, noted in their ledger."""
    layers = private_layers(spark)
    of_google, of_meta, of_mart = daily.watches(spark, layers)
    for part in _two_arrivals(spark, sf):
        writes.append_raw(part, layers.raw_google, watch=of_google)
    writes.append_raw(adapters.raw_meta(spark, sf), layers.raw_meta, watch=of_meta)
    writes.dedup_days(spark, layers.raw_google, watch=of_google)
    writes.write_mart(all_runs_mart(spark, sf), layers.mart, of_mart)
    writes.refresh_mart(late_window(the_mart(spark, sf), AS_OF, "report_date"), layers.mart, of_mart)
    return layers


def ledger_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger beside a recount of the stored tables."""
    return daily.audit_ledger(spark, ledger_layers(spark, sf))


def ledger_volumes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by ingestion day from the ledger, with the change against the day before."""
    ledger = Ledger(spark, ledger_layers(spark, sf).ledger)
    return volume.ledger_history(ledger, *ALL_DAYS)


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    folder = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return scan(rows.sparkSession, folder, rows.schema)


def platform_states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored states and bitmaps of each day and platform; campaigns are numbered in two rounds."""
    rows = stored(the_mart(spark, sf), "rollup-mart")
    first = stored(rollup.number_campaigns(rows.where(F.col("report_date") < RANGE[0])), "rollup-numbers")
    numbers = stored(rollup.number_campaigns(rows, first), "rollup-numbers")
    return stored(rollup.daily_states(rows), "rollup-states"), stored(rollup.daily_bitmaps(rows, numbers), "rollup-bitmaps")


def comparison_by_rollup(rounded: bool) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        states, bitmaps = platform_states(spark, sf)
        window = rollup.window_state(states, AS_OF, 7)
        return rollup.platform_comparison(window, rollup.distinct_campaigns(bitmaps, AS_OF, 7), rounded)

    return query


def rolling_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct campaigns of the eight days up to every day."""
    return rollup.rolling_campaigns(platform_states(spark, sf)[1], 7)


def campaigns_by_rollup(ranking: Callable[[DataFrame], DataFrame]) -> Query:
    """The window three days before, moved on day by day."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        by = rollup.CAMPAIGN
        states = stored(rollup.daily_states(the_mart(spark, sf), by), "rollup-campaigns")
        days_before = [dt.date.fromisoformat(AS_OF) - dt.timedelta(n) for n in (3, 2, 1, 0)]
        known = states.where(F.col("report_date") <= F.lit(days_before[0]))
        window = rollup.window_state(known, days_before[0], 20, by)
        for day in days_before[1:]:
            window = stored(rollup.advance(window, states, day, 20, by), "rollup-window")
        return ranking(window)

    return query


# Quality


def dq_report(name: str, source: Query = the_mart) -> Query:
    return lambda spark, sf: quality.violations(source(spark, sf), quality.mart_test(name))


def dq_clicks_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The report's newest thousand rows of those in dq_clicks_all_runs."""
    check = quality.mart_test("clicks_not_exceeding_impressions")
    return quality.violations(all_runs_mart(spark, sf), check, newest=S.VIOLATION_REPORT_ROWS)


def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    frames = model(spark, sf)
    return quality.accepted_values_suite({t: frames[t] for t in quality.ACCEPTED_PLATFORMS})


def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    google, meta = latest(spark, sf)
    return suite.run_model_suite(google, meta, mart.mart_from_raw(google, meta, CREATED_AT))


def dq_suite_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_suite(model(spark, sf))


def digest_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days by their recorded digests: whether some key of the unified rows of all runs repeats."""
    recorded = stored(digests.day_digests(all_runs_unified(spark, sf)), "digests")
    repeated = digests.repeated_days(recorded).withColumn("repeated", F.lit(True))
    return recorded.join(repeated, "day", "left").select(
        "day", "n_rows", "n_keys", F.coalesce("repeated", F.lit(False)).alias("repeated")
    )


def digest_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated keys, of which only days whose digests differ are grouped."""
    rows = all_runs_unified(spark, sf)
    recorded = stored(digests.day_digests(rows), "digests")
    return digests.duplicates_of_days(rows, digests.repeated_days(recorded))


def widened_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of texts whose columns and types differ, in one table."""
    google, folder = adapters.raw_google(spark, sf), shared_folder(spark, "widened")
    whole = F.floor("cost_usd").alias("cost")
    batches = {
        "run_0": [F.col("clicks"), whole, F.col("clicks").alias("note")],
        "run_1": [(F.col("clicks") * 3_000_000_000).alias("clicks"), F.col("cost_usd").alias("cost")],
        "run_2": [F.col("clicks"), whole, F.lit("n/a").alias("note"), F.col("impressions").alias("extra")],
    }
    for run, columns in batches.items():
        part = google.where(F.col("extract_run_id") == run).select("date", "campaign_id", *columns)
        widening.append_widening(part.select(*(F.col(c).cast("string").alias(c) for c in part.columns)), folder)
    return widening.read_widened(spark, folder)


# Volume


def volume_result(spark: SparkSession, sf: str) -> DataFrame:
    google, meta = latest(spark, sf)
    counts = suite.model_day_counts(
        google, meta, mart.mart_from_raw(google, meta, CREATED_AT), AS_OF
    )
    return volume.evaluate(counts, volume.default_thresholds(spark))


def volume_checks_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return joined_texts(volume.volume_checks(spark, watched(spark, sf), AS_OF))


def ingestion_day_counts(spark: SparkSession, sf: str) -> DataFrame:
    return volume.counts_by_table(spark, watched(spark, sf), AS_OF)


def volume_history(spark: SparkSession, sf: str) -> DataFrame:
    return volume.volume_history(the_mart(spark, sf), *ALL_DAYS)


# The same operators where rules are broken: faults derived from the given tables


def spoilt_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of all runs with NULL keys, an unknown platform, negative spend, and click
    rates shifted beyond the tolerance or just within it."""
    every = lambda n, column: F.col(column) % n == 0
    return all_runs_mart(spark, sf).withColumns(
        {
            "campaign_id": F.when(~every(7, "clicks"), F.col("campaign_id")),
            "platform": F.when(every(11, "clicks"), "other_ads").otherwise(F.col("platform")),
            "spend": F.when(every(13, "clicks"), -F.col("spend")).otherwise(F.col("spend")),
            "ctr": F.when(every(5, "impressions"), F.col("ctr") + 0.01)
            .when(every(3, "impressions"), F.col("ctr") + 0.00005)
            .otherwise(F.col("ctr")),
        }
    )


def spoilt_model(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Every model over raw rows of which some lack keys and metrics; the unified rows lose theirs again."""
    every = lambda n, column: F.col(column) % n == 0
    google, meta = raw(spark, sf)
    google = google.withColumns(
        {
            "date": F.when(~every(17, "impressions"), F.col("date")),
            "campaign_id": F.when(~every(7, "impressions"), F.col("campaign_id")),
            "conversions": F.when(~every(5, "clicks"), F.col("conversions")),
            "cost_usd": F.when(~every(3, "clicks"), F.col("cost_usd")),
        }
    )
    meta = meta.withColumns(
        {
            "date": F.when(~every(19, "page_engagement"), F.col("date")),
            "campaign_id": F.when(~every(2, "likes"), F.col("campaign_id")),
            "impressions": F.when(~every(3, "clicks"), F.col("impressions")),
            "spend_usd": F.when(~every(2, "shares"), F.col("spend_usd")),
        }
    )
    stg_google, stg_meta = staging.stage_google(google), staging.stage_meta(meta)
    union = unified.unify(stg_google, stg_meta).withColumns(
        {
            "platform": F.when(~every(6, "clicks"), F.col("platform")),
            "campaign_id": F.when(~every(10, "clicks"), F.col("campaign_id")),
        }
    )
    return {
        S.RAW_GOOGLE_TABLE: google, S.RAW_META_TABLE: meta, S.STG_GOOGLE_TABLE: stg_google,
        S.STG_META_TABLE: stg_meta, S.UNIFIED_TABLE: union,
    }


def dq_spoilt_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null_suite(spoilt_model(spark, sf))


def dq_stale_recency(spark: SparkSession, sf: str) -> DataFrame:
    """The mart as it was eight days before the last, and as it was seven days before."""
    rows = the_mart(spark, sf)

    def as_it_was(days_ago: int) -> DataFrame:
        known = rows.where(F.col("report_date") <= F.date_sub(F.lit(AS_OF).cast("date"), days_ago))
        return quality.recency(known, AS_OF).withColumn("days_ago", F.lit(days_ago))

    return as_it_was(8).unionByName(as_it_was(7)).unionByName(as_it_was(400))


def dq_spoilt_suite(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_suite({S.MART_TABLE: spoilt_mart(spark, sf)})


def over_spoilt(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(spoilt_mart(spark, sf))


def broken_volumes(spark: SparkSession, sf: str) -> DataFrame:
    limits = spark.createDataFrame(
        [(*row, "seeded") for row in BROKEN_LIMITS],
        "table_name string, min_daily_records bigint, max_daily_records bigint,"
        " max_variance_percent bigint, description string",
    )
    tables = {**watched(spark, sf), "absent_table": lambda: spark.table("absent_table")}
    checks = volume.volume_checks(spark, tables, AS_OF, limits)
    # Of the absent table's message, its code.
    code = F.regexp_extract("error", r"\[(\w+)", 1)
    told = F.col("error").isNotNull()
    return checks.withColumns(
        {
            "errors": F.when(told, F.array(code)).otherwise(F.col("errors")),
            "error": F.when(told, code),
        }
    )


def volume_broken_report(spark: SparkSession, sf: str) -> DataFrame:
    return volume.report(broken_volumes(spark, sf))


def meta_flatten_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Each action twice, the second time with ten times its value, and an entry that is NULL."""
    tenfold = F.transform(
        "actions",
        lambda a: F.struct(
            a.getField("action_type").alias("action_type"),
            F.concat(a.getField("value"), F.lit("0")).alias("value"),
        ),
    )
    nothing = F.array(F.lit(None).cast("struct<action_type:string,value:string>"))
    payload = adapters.meta_insights(spark, sf)
    return flatten_insights(payload.withColumn("actions", F.concat("actions", tenfold, nothing)))


def typed_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """Text of which some is malformed; that reads as NULL."""
    google = adapters.raw_google(spark, sf)
    as_text = google.select(*(F.col(c).cast("string").alias(c) for c in S.GOOGLE_RECORD.names))
    spoilt = F.when(F.col("impressions").cast("bigint") % 7 == 0, "n/a").otherwise(F.col("clicks"))
    return staging.typed(as_text.withColumn("clicks", spoilt), S.GOOGLE_RECORD, lenient=True)


#: Records of one array file, about.
ARRAY_RECORDS = 20_000


def _array_files(spark: SparkSession, records: DataFrame, purpose: str) -> str:
    """Files of one JSON array each, as the samples are; a day has as many as its records need."""
    folder = shared_folder(spark, purpose)
    record = F.struct(*records.columns)
    days = records.groupBy(F.col("date").alias("day")).agg(F.ceil(F.count("*") / ARRAY_RECORDS).alias("files"))
    # Records differ (day, run and campaign are their key), so a hash of all columns deals them evenly.
    dealt = records.join(F.broadcast(days), F.col("date").eqNullSafe(F.col("day")))
    salted = dealt.select(*records.columns, F.pmod(F.xxhash64(*records.columns), F.col("files")).alias("salt"))
    arrays = salted.groupBy("date", "salt").agg(F.to_json(F.collect_list(record)).alias("value"))
    # A reader takes one array from a file.
    arrays.drop("salt").write.option("maxRecordsPerFile", 1).partitionBy("date").text(folder)
    return folder


def _by_account(raw: DataFrame, spend: str) -> DataFrame:
    return raw.select(
        "date",
        F.concat(F.lit("acc_"), "extract_run_id").alias("account_id"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        "campaign_name",
        "impressions",
        "clicks",
        F.col(spend).alias("spend"),
        (F.col("clicks") % 9).alias("conversions"),
    )


def google_array_files(spark: SparkSession, sf: str) -> DataFrame:
    records = _by_account(adapters.raw_google(spark, sf), "cost_usd")
    folder = _array_files(spark, records, "google-arrays")
    return sources.GOOGLE_SAMPLE.read(spark, folder, *RANGE)


def meta_array_files(spark: SparkSession, sf: str) -> DataFrame:
    records = _by_account(adapters.raw_meta(spark, sf), "spend_usd")
    folder = _array_files(spark, records, "meta-arrays")
    return sources.META_SAMPLE.read(spark, folder, *RANGE)


def stream_and_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Stream, append, deduplicate, stream again: one table, one layout, newest rows win."""
    payload = adapters.meta_insights(spark, sf)
    landing, checkpoint = shared_folder(spark, "mixed-landing"), shared_folder(spark, "mixed-checkpoint")
    table = private_layers(spark).raw_meta

    def stream(part: DataFrame) -> None:
        part.hint("rebalance", "date_start").write.mode("append").partitionBy("date_start").json(landing)
        ingest.ingest_landed(
            spark, sources.META_NESTED, landing, table, checkpoint, "meta",
            ingested_at=lambda batch: INGESTED_AT,
        )

    first = F.col("date_start") < RANGE[1]
    stream(payload.where(first))
    batch = flatten_insights(payload.where(F.col("date_start") >= RANGE[0]))
    writes.append_raw(metadata.stamp(batch, S.META, "batch", LATER), table)
    writes.dedup_days(spark, table)
    stream(payload.where(~first))
    writes.dedup_days(spark, table)
    writes.compact_days(spark, table, F.col("date") < RANGE[0])
    return scan_as(spark, table, S.RAW_META).drop("extract_run_id", "conversions")


def catalog_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog tables with rows and flag, in order; their sizes are those of the files rows come from."""
    layers = private_layers(spark)
    google, meta = raw(spark, sf)
    writes.append_raw(google, layers.raw_google)
    writes.append_raw(meta.where("false"), layers.raw_meta)
    found = catalog.table_inventory(spark, layers.schemas["raw"])
    of_rows = reduce(
        DataFrame.unionByName,
        (
            catalog.file_inventory(name, spark.table(table))
            for name, table in ((S.RAW_GOOGLE_TABLE, layers.raw_google), (S.RAW_META_TABLE, layers.raw_meta))
        ),
    ).select("table_name", F.col("size_mb").alias("mb_of_rows"))
    # An empty table has files without rows.
    agrees = (F.col("size_mb") == F.col("mb_of_rows")) | (F.col("is_empty") & (F.col("size_mb") < 0.1))
    return found.join(of_rows, "table_name").select("table_name", "row_count", "is_empty", agrees.alias("size_agrees"))


def inventory_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a stored table by day from its ledger, beside its files."""
    layers = ledger_layers(spark, sf)
    found = catalog.inventory_by_day(
        spark, catalog.location_of(spark, layers.mart), Ledger(spark, layers.ledger), S.MART_TABLE, "report_date"
    )
    seen = (F.col("n_files") > 0) & (F.col("bytes") > 0) & F.col("modified_at").isNotNull()
    return found.select("day", "row_count", seen.alias("has_files"))


# Run log and catalog


def _run(counts: tuple[int, int]) -> runlog.Run:
    return runlog.Run(
        run_id="run_fixed",
        dag_id="campaign_daily",
        run_date=AS_OF,
        execution_date="2024-01-30T05:00:00+00:00",
        status="success",
        google_ads=runlog.SourceResult(counts[0], "success"),
        meta_ads=runlog.SourceResult(counts[1], "success"),
    )


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    google, meta = latest(spark, sf)
    return runlog.run_summary(
        spark,
        _run((google.count(), meta.count())),
        dq_suite(spark, sf),
        volume_result(spark, sf),
        "2024-01-30T05:02:03.600+00:00",
    )


def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A log with one run per ingestion day and run id, as the raw zone records them."""
    log = (
        all_runs_unified(spark, sf)
        .groupBy("ingested_at")
        .agg(F.count_if(F.col("platform") == S.GOOGLE).alias("n_google"))
        .select(
            F.date_format("ingested_at", "'run-'yyyyMMddHH").alias("run_id"),
            F.lit("campaign_daily").alias("dag_id"),
            F.to_date("ingested_at").alias("run_date"),
            F.col("ingested_at").alias("execution_date"),
            F.lit(60).cast("bigint").alias("duration_seconds"),
            F.lit("success").alias("status"),
            F.when(F.col("n_google") > 0, "success").otherwise("empty").alias("google_ads_status"),
            F.lit("success").alias("meta_ads_status"),
            F.lit("not_run").alias("dbt_test_status"),
            F.lit("not_run").alias("volume_check_status"),
        )
    )
    return runlog.recent_runs(log)


def _daily(
    spark: SparkSession, layers: daily.Layers, number: int, rows: tuple[DataFrame, DataFrame], since=None
) -> DataFrame:
    ran = F.col("extract_run_id") == f"run_{number}"
    google, meta = (r.where(ran).drop(*S.METADATA_COLUMNS) for r in rows)
    return daily.run_daily(
        spark,
        google,
        meta,
        layers,
        AS_OF,
        run_id=f"daily_{number}",
        ingested_at=f"{adapters.LAST_DAY}T0{number}:00:00+00:00",
        started_at=f"{adapters.LAST_DAY}T0{number}:00:00+00:00",
        ended_at=f"{adapters.LAST_DAY}T0{number}:01:30+00:00",
        since=since,
    )


def daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of the whole chain over stored tables; the last one's log row."""
    layers, rows = private_layers(spark), raw(spark, sf)
    for number in (0, 1, 2):
        summary = _daily(spark, layers, number, rows)
    return summary


def daily_mart_since(spark: SparkSession, sf: str) -> DataFrame:
    """The mart after a full run and two that only cover the days since."""
    layers, rows = private_layers(spark), raw(spark, sf)
    _daily(spark, layers, 0, rows)
    recent = tuple(r.where(F.col("date") >= RANGE[0]) for r in rows)
    for number in (1, 2):
        _daily(spark, layers, number, recent, since=RANGE[0])
    return scan_as(spark, layers.mart, S.MART).drop("mart_created_at")


def table_inventory(spark: SparkSession, sf: str) -> DataFrame:
    inventories = (
        catalog.file_inventory(name, scan(spark, f"{sf}/{name}.parquet")) for name in TABLES
    )
    return reduce(DataFrame.unionByName, inventories).drop("size_mb")


def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Instants by way of milliseconds and as text, and sizes in megabytes, as inventories show them."""
    events = scan(spark, f"{sf}/events.parquet")
    at = conversion.from_millis(F.unix_millis(F.col("ts").cast("timestamp")))
    return events.select(
        "event_id",
        at.alias("at"),
        days.iso_text(at).alias("at_text"),
        conversion.to_megabytes(F.col("event_id") * 4096).alias("size_mb"),
    )


QUERIES: dict[str, Query] = {
    # sources
    "google_extract": google_extract,
    "meta_extract": meta_extract,
    "meta_flatten": meta_flatten,
    "meta_insights_extract": meta_insights_extract,
    "account_records": account_records,
    "calendar_scaffold": calendar_scaffold,
    "missing_campaign_days": missing_campaign_days,
    "missing_from_dimension": missing_from_dimension,
    "missing_runs": missing_runs,
    "missing_days_unrolled": missing_days_unrolled,
    # raw zone
    "ingestion_metadata": ingestion_metadata,
    "raw_append": raw_append,
    "widened_batches": widened_batches,
    "raw_backfill": raw_backfill,
    "raw_replace_days": raw_replace_days,
    "raw_rewrite": raw_rewrite,
    "dedup_google": lambda spark, sf: latest(spark, sf)[0],
    "dedup_meta": lambda spark, sf: latest(spark, sf)[1],
    "late_window": lambda spark, sf: late_window(adapters.raw_meta(spark, sf), AS_OF),
    "late_restatement": late_restatement,
    "restated_bucketed": restated_bucketed,
    "ingestion_profile": ingestion_profile,
    "stream_ingest": stream_ingest,
    "stream_newest": stream_newest,
    # models
    "stg_google": lambda spark, sf: staging.stage_google(adapters.raw_google(spark, sf)),
    "stg_meta": lambda spark, sf: staging.stage_meta(adapters.raw_meta(spark, sf)),
    "typed_staging": typed_staging,
    "quality_flags": quality_flags,
    "unified": all_runs_unified,
    "unified_latest": lambda spark, sf: latest_unified(all_runs_unified(spark, sf)),
    "mart": the_mart,
    "mart_table": mart_table,
    "mart_swapped": mart_swapped,
    "mart_refreshed": mart_refreshed,
    "mart_by_sql": mart_by_sql,
    "kpi_targets": kpi_targets,
    # analysis
    "top_roas": over_mart(lambda m: analysis.top_roas(m, AS_OF)),
    "platform_comparison": over_mart(lambda m: analysis.platform_comparison(m, AS_OF)),
    "daily_trend": over_mart(lambda m: analysis.daily_trend(m, "Campaign 7", AS_OF)),
    "efficiency_bands": over_mart(lambda m: analysis.efficiency_bands(m, AS_OF)),
    "top_spend": over_mart(lambda m: analysis.top_spend(m, AS_OF)),
    "platform_comparison_raw": over_mart(lambda m: analysis.platform_comparison_raw(m, AS_OF)),
    "rollup_platform_comparison": comparison_by_rollup(True),
    "rollup_platform_comparison_raw": comparison_by_rollup(False),
    "rollup_rolling_campaigns": rolling_campaigns,
    "rollup_top_roas": campaigns_by_rollup(rollup.top_roas),
    "rollup_top_spend": campaigns_by_rollup(rollup.top_spend),
    # quality
    "dq_not_null": lambda spark, sf: quality.not_null_suite(model(spark, sf)),
    "dq_accepted_values": dq_accepted_values,
    "dq_duplicate_grain": lambda spark, sf: quality.duplicate_grain(all_runs_unified(spark, sf)),
    "dq_clicks_not_exceeding_impressions": dq_report("clicks_not_exceeding_impressions"),
    "dq_clicks_all_runs": dq_report("clicks_not_exceeding_impressions", all_runs_mart),
    "dq_clicks_newest": dq_clicks_newest,
    "dq_ctr_not_exceeding_100_percent": dq_report("ctr_not_exceeding_100_percent"),
    "dq_kpi_calculations": dq_report("kpi_calculations"),
    "dq_no_negative_metrics": dq_report("no_negative_metrics"),
    "dq_accepted_range": over_mart(quality.accepted_range),
    "dq_recency": over_mart(lambda m: quality.recency(m, AS_OF)),
    "dq_suite": dq_suite,
    "dq_suite_by_table": dq_suite_by_table,
    "digest_days": digest_days,
    "digest_duplicates": digest_duplicates,
    "dq_tally": lambda spark, sf: quality.tally(dq_suite(spark, sf)),
    # volume
    "ingestion_day_counts": ingestion_day_counts,
    "volume_checks": lambda spark, sf: joined_texts(volume_result(spark, sf)),
    "volume_checks_by_table": volume_checks_by_table,
    "volume_summary": lambda spark, sf: volume.summarize(volume_result(spark, sf)),
    "volume_report": lambda spark, sf: volume.report(volume_result(spark, sf)),
    "volume_history": volume_history,
    "ledger_audit": ledger_audit,
    "ledger_volumes": ledger_volumes,
    # broken rules
    "dq_spoilt_suite": dq_spoilt_suite,
    "dq_spoilt_not_null": dq_spoilt_not_null,
    "dq_stale_recency": dq_stale_recency,
    "dq_spoilt_kpis": over_spoilt(
        lambda m: quality.violations(m, quality.mart_test("kpi_calculations"))
    ),
    "dq_spoilt_negatives": over_spoilt(
        lambda m: quality.violations(m, quality.mart_test("no_negative_metrics"))
    ),
    "dq_spoilt_range": over_spoilt(quality.accepted_range),
    "volume_broken": lambda spark, sf: joined_texts(broken_volumes(spark, sf)),
    "volume_broken_report": volume_broken_report,
    "volume_broken_summary": lambda spark, sf: volume.summarize(broken_volumes(spark, sf)),
    "meta_flatten_repeated": meta_flatten_repeated,
    "typed_lenient": typed_lenient,
    "google_array_files": google_array_files,
    "meta_array_files": meta_array_files,
    "stream_and_batch": stream_and_batch,
    "catalog_inventory": catalog_inventory,
    "inventory_by_day": inventory_by_day,
    # run log and catalog
    "run_summary": run_summary,
    "recent_runs": recent_runs,
    "daily_run": daily_run,
    "daily_mart_since": daily_mart_since,
    "table_inventory": table_inventory,
    "event_times": event_times,
}


def registered() -> dict[str, Query]:
    """Each query pins the session settings it relies on before it runs."""

    def pinned(query: Query) -> Query:
        return lambda spark, sf: query(configure(spark), sf)

    return {name: pinned(query) for name, query in QUERIES.items()}
