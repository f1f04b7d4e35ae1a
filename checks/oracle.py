"""The registered queries in SQL, over the same tables.

Rounding goes through decimal text because binary rounding settles decimal ties
differently; money is added as decimals; integer sums are cast back to BIGINT.
"""

from __future__ import annotations

from collections.abc import Iterable

from adloom import schemas as S
from adloom.operators import quality

AS_OF = "DATE '2024-01-30'"
CREATED_AT = "TIMESTAMP '2024-01-31 00:00:00'"
INGESTED_AT = "TIMESTAMP '2024-02-01 06:00:00'"
IN_RANGE = "BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
ALL_DAYS = (
    "SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30',"
    " INTERVAL 1 DAY)) AS DATE)"
)


def rounded(value: str, digits: int) -> str:
    return (
        f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
    )


def total(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,6))) AS DOUBLE)"


def mean(column: str) -> str:
    return f"({total(column)} / CAST(count({column}) AS DOUBLE))"


RAW_GOOGLE = """
raw_google AS (
  SELECT date,
         'camp_' || l_suppkey AS campaign_id,
         'Campaign ' || l_suppkey AS campaign_name,
         impressions, clicks, conversions, cost_usd,
         CAST(date AS TIMESTAMP) + INTERVAL 1 DAY + to_hours(run) AS ingested_at,
         'run_' || run AS extract_run_id,
         'google_ads' AS source
  FROM (
    SELECT DATE '2024-01-01'
             + CAST((((CAST(l_shipdate AS DATE) - DATE '1995-01-01') % 30) + 30) % 30 AS INTEGER)
             AS date,
           l_suppkey,
           CAST(l_orderkey % 3 AS INTEGER) AS run,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS impressions,
           CAST(sum(l_linenumber) AS BIGINT) AS clicks,
           count(*) FILTER (WHERE l_returnflag = 'N') AS conversions,
           CAST(round(sum(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))), 2)
             AS DOUBLE) AS cost_usd
    FROM lineitem
    GROUP BY 1, 2, 3
  )
)"""

RAW_META = """
raw_meta AS (
  SELECT date, campaign_id, 'Meta ' || campaign_id AS campaign_name,
         20 * views AS impressions, clicks, spend_usd,
         signups AS likes, errors AS comments, purchases AS shares,
         views AS video_views, events AS page_engagement,
         CAST(date AS TIMESTAMP) + INTERVAL 1 DAY + to_hours(run) AS ingested_at,
         'run_' || run AS extract_run_id,
         'meta_ads' AS source
  FROM (
    SELECT CAST(ts AS DATE) AS date,
           user_id AS campaign_id,
           CAST(event_id % 3 AS INTEGER) AS run,
           count(*) FILTER (WHERE event_type = 'view') AS views,
           count(*) FILTER (WHERE event_type = 'click') AS clicks,
           count(*) FILTER (WHERE event_type = 'signup') AS signups,
           count(*) FILTER (WHERE event_type = 'error') AS errors,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
           count(*) AS events,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend_usd
    FROM events
    GROUP BY 1, 2, 3
  )
)"""

RAW = f"{RAW_GOOGLE},{RAW_META}"

FLAT_META = """
flat_meta AS (
  SELECT CAST(ts AS DATE) AS date,
         CAST(user_id AS VARCHAR) AS campaign_id,
         'Meta ' || user_id AS campaign_name,
         20 * count(*) FILTER (WHERE event_type = 'view') AS impressions,
         count(*) FILTER (WHERE event_type = 'click') AS clicks,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend_usd,
         count(*) FILTER (WHERE event_type = 'signup') AS likes,
         count(*) FILTER (WHERE event_type = 'error') AS comments,
         count(*) FILTER (WHERE event_type = 'purchase') AS shares,
         count(*) FILTER (WHERE event_type = 'view') AS video_views,
         CAST(0 AS BIGINT) AS page_engagement
  FROM events
  GROUP BY ts::DATE, user_id
)"""


def newest(name: str, source: str, where: str = "TRUE", keys: str = "date, campaign_id") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (position) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {keys} ORDER BY ingested_at DESC, extract_run_id DESC) AS position
    FROM {source} WHERE {where})
  WHERE position = 1
)"""


def models(google: str, meta: str) -> str:
    return f"""
stg_google AS (
  SELECT date AS report_date, campaign_id, campaign_name, impressions, clicks, conversions,
         cost_usd, ingested_at, extract_run_id, source
  FROM {google} WHERE date IS NOT NULL AND campaign_id IS NOT NULL
),
stg_meta AS (
  SELECT date AS report_date, campaign_id, campaign_name, impressions, clicks, spend_usd,
         likes, comments, shares, video_views, page_engagement,
         ingested_at, extract_run_id, source
  FROM {meta} WHERE date IS NOT NULL AND campaign_id IS NOT NULL
),
unified AS (
  SELECT report_date, CAST(campaign_id AS VARCHAR) AS campaign_id, campaign_name,
         impressions, clicks, conversions, cost_usd AS spend,
         CAST(NULL AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS comments,
         CAST(NULL AS BIGINT) AS shares, CAST(NULL AS BIGINT) AS video_views,
         CAST(NULL AS BIGINT) AS page_engagement,
         ingested_at, extract_run_id, source, 'google_ads' AS platform
  FROM stg_google
  UNION ALL
  SELECT report_date, CAST(campaign_id AS VARCHAR), campaign_name,
         impressions, clicks, NULL, spend_usd,
         likes, comments, shares, video_views, page_engagement,
         ingested_at, extract_run_id, source, 'meta_ads'
  FROM stg_meta
),
mart AS (
  SELECT report_date, campaign_id, campaign_name, platform, impressions, clicks, spend,
         conversions, likes, comments, shares, video_views, page_engagement,
         CASE WHEN impressions > 0 THEN
           {rounded("CAST(clicks AS DOUBLE) / impressions", 4)} END AS ctr,
         CASE WHEN conversions > 0 THEN {rounded("spend / conversions", 2)} END AS cpa,
         CASE WHEN spend > 0 THEN {rounded("conversions / spend", 4)} END AS roas,
         CASE WHEN clicks > 0 THEN {rounded("spend / clicks", 2)} END AS cpc,
         CASE WHEN clicks > 0 THEN
           {rounded("CAST(conversions AS DOUBLE) / clicks", 4)} END AS conversion_rate,
         ingested_at, extract_run_id, source, {CREATED_AT} AS mart_created_at
  FROM unified
  WHERE report_date IS NOT NULL AND campaign_id IS NOT NULL AND platform IS NOT NULL
)"""


LATEST = f"{RAW},{newest('google', 'raw_google')},{newest('meta', 'raw_meta')}"
MODELS = f"{LATEST},{models('google', 'meta')}"
ALL_RUNS = f"{RAW},{models('raw_google', 'raw_meta')}"

# Names of the models in the reports, and the relations above that hold them.
RELATIONS = {
    S.RAW_GOOGLE_TABLE: "google",
    S.RAW_META_TABLE: "meta",
    S.STG_GOOGLE_TABLE: "stg_google",
    S.STG_META_TABLE: "stg_meta",
    S.UNIFIED_TABLE: "unified",
    S.MART_TABLE: "mart",
}


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


GOOGLE_RECORD = "date, campaign_id, campaign_name, impressions, clicks, conversions, cost_usd"
META_RECORD = (
    "date, CAST(campaign_id AS VARCHAR) AS campaign_id, campaign_name, impressions, clicks,"
    " CAST(NULL AS BIGINT) AS conversions, spend_usd, likes, comments, shares, video_views,"
    " page_engagement"
)


# Quality


def violation_count(table: str, check: str, predicate: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name,"
        f" count(*) FILTER (WHERE {predicate}) AS violations FROM {RELATIONS[table]}"
    )


def not_null_counts() -> list[str]:
    return [
        violation_count(table, f"not_null_{column}", f"{column} IS NULL")
        for table, columns in quality.NOT_NULL.items()
        for column in columns
    ]


def accepted_counts() -> list[str]:
    return [
        violation_count(
            table, "accepted_values_platform", "platform NOT IN ('google_ads', 'meta_ads')"
        )
        for table in (S.UNIFIED_TABLE, S.MART_TABLE)
    ]


MART_PREDICATES = {
    "clicks_not_exceeding_impressions": "clicks > impressions",
    "ctr_not_exceeding_100_percent": "ctr > 1.0",
    "no_negative_metrics": "impressions < 0 OR clicks < 0 OR spend < 0 OR conversions < 0",
    "kpi_calculations": (
        "(impressions > 0 AND ctr IS NOT NULL"
        " AND abs(CAST(clicks AS DOUBLE) / impressions - ctr) > 0.0001)"
        " OR (clicks > 0 AND cpc IS NOT NULL AND abs(spend / clicks - cpc) > 0.01)"
        " OR (conversions > 0 AND cpa IS NOT NULL AND abs(spend / conversions - cpa) > 0.01)"
    ),
}


def suite_counts() -> str:
    unique = [
        f"""SELECT '{table}' AS table_name, 'unique_combination_grain' AS check_name,
                   count(*) AS violations
            FROM (SELECT 1 FROM {RELATIONS[table]}
                  GROUP BY report_date, campaign_id, platform HAVING count(*) > 1)"""
        for table in (S.UNIFIED_TABLE, S.MART_TABLE)
    ]
    singular = [
        violation_count(S.MART_TABLE, check, predicate)
        for check, predicate in MART_PREDICATES.items()
    ]
    return "\nUNION ALL ".join(not_null_counts() + accepted_counts() + unique + singular)


def suite(counts: str) -> str:
    tests = ", ".join(f"'{name}'" for name in MART_PREDICATES)
    return f"""SELECT table_name, check_name, violations,
       CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN check_name IN ({tests}) THEN least(violations, 1000) ELSE violations END
         AS reported_rows
FROM ({counts})"""


def statuses(counts: Iterable[str]) -> str:
    return f"""SELECT *, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM ({" UNION ALL ".join(counts)})"""


TALLY = f"""
tally AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE status = 'PASS') AS passed,
         count(*) FILTER (WHERE status = 'FAIL') AS failed,
         count(*) FILTER (WHERE status = 'WARN') AS warned
  FROM ({suite(suite_counts())})
)"""


def all_violations(check: str, columns: str) -> str:
    return f"""SELECT report_date, campaign_id, platform{columns} FROM mart
WHERE {MART_PREDICATES[check]}"""


def accepted_range() -> str:
    columns = (
        "impressions", "clicks", "spend", "conversions",
        "ctr", "cpa", "roas", "cpc", "conversion_rate",
    )
    return statuses(
        [
            f"SELECT 'accepted_range_{c}' AS check_name,"
            f" count(*) FILTER (WHERE {c} < 0) AS violations FROM mart"
            for c in columns
        ]
    )


# Volume

WATCHED = [t for t in RELATIONS if t != S.UNIFIED_TABLE]


def day_counts(as_of: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{table}' AS table_name,
       count(*) FILTER (WHERE CAST(ingested_at AS DATE) = {as_of}) AS today_count,
       count(*) FILTER (WHERE CAST(ingested_at AS DATE) = {as_of} - 1) AS yesterday_count
FROM {RELATIONS[table]}"""
        for table in WATCHED
    )


LIMITS = ", ".join(
    f"('{table}', {low}, {high}, {change}, '{text}')"
    for _, table, low, high, change, text in S.VOLUME_THRESHOLDS
)

def volume_of(limits: str, failed: str = "") -> str:
    """``failed`` may add rows of tables that couldn't be read."""
    return f"""
measured AS (
  SELECT l.*, today_count AS today, yesterday_count AS yesterday,
         CASE WHEN yesterday_count > 0
           THEN CAST(abs(today_count - yesterday_count) AS DOUBLE) / yesterday_count * 100
           ELSE 0.0 END AS change
  FROM (VALUES {limits}) AS l(table_name, low, high, allowed, description)
  JOIN ({day_counts(AS_OF)}) USING (table_name)
),
volume AS (
  SELECT table_name, description, today AS today_count, yesterday AS yesterday_count,
         CAST(printf('%.2f', change) AS DOUBLE) AS variance_percent,
         CASE WHEN change > allowed THEN 'WARN'
              WHEN today < low OR today > high THEN 'FAIL' ELSE 'PASS' END AS status,
         CASE WHEN today < low OR today > high THEN 'FAIL'
              WHEN change > allowed THEN 'WARN' ELSE 'PASS' END AS max_severity,
         concat_ws('; ',
           CASE WHEN today < low THEN
             printf('Record count (%d) below minimum threshold (%d)', today, low) END,
           CASE WHEN today > high THEN
             printf('Record count (%d) exceeds maximum threshold (%d)', today, high) END,
           CASE WHEN change > allowed THEN
             printf('Day-over-day variance (%.1f%%) exceeds threshold (%d%%)',
                    change, allowed) END) AS issues,
         concat_ws('; ', CASE WHEN change > allowed THEN
           printf('%s: High variance (%.1f%%, yesterday: %d)',
                  table_name, change, yesterday) END) AS warnings,
         concat_ws('; ',
           CASE WHEN today < low THEN
             printf('%s: Below minimum threshold (%d/%d)', table_name, today, low) END,
           CASE WHEN today > high THEN
             printf('%s: Exceeds maximum threshold (%d/%d)', table_name, today, high) END)
           AS errors,
         CAST(NULL AS VARCHAR) AS error
  FROM measured {failed}
),
volume_totals AS (
  SELECT count(*) AS total_tables,
         count(*) FILTER (WHERE status = 'PASS') AS passed,
         count(*) FILTER (WHERE status = 'WARN') AS warned,
         count(*) FILTER (WHERE status = 'FAIL') AS failed,
         count(*) FILTER (WHERE status = 'ERROR') AS errored,
         CASE WHEN count(*) FILTER (WHERE status IN ('FAIL', 'ERROR')) = 0
           THEN 'PASS' ELSE 'FAIL' END AS overall_status
  FROM volume
)"""


VOLUME = volume_of(LIMITS)


def run_row(run: str, start: str, end: str, seconds: int, google: str, meta: str) -> str:
    return f"""SELECT '{run}' AS run_id, 'campaign_daily' AS dag_id, {AS_OF} AS run_date,
       TIMESTAMP '{start}' AS execution_date, TIMESTAMP '{start}' AS start_time,
       TIMESTAMP '{end}' AS end_time, CAST({seconds} AS BIGINT) AS duration_seconds,
       'success' AS status,
       ({google}) AS google_ads_extracted_count, 'success' AS google_ads_status,
       ({meta}) AS meta_ads_extracted_count, 'success' AS meta_ads_status,
       FALSE AS dbt_docs_generated,
       CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS VARCHAR) AS error_task,
       TIMESTAMP '{end}' AS created_at, TIMESTAMP '{end}' AS updated_at,
       CASE WHEN t.failed = 0 THEN 'success' ELSE 'failed' END AS dbt_run_status,
       CASE WHEN t.failed = 0 THEN 'success' ELSE 'failed' END AS dbt_test_status,
       t.passed AS dbt_test_passed, t.failed AS dbt_test_failed, t.warned AS dbt_test_warnings,
       v.overall_status AS volume_check_status,
       v.total_tables AS volume_check_tables_checked, v.passed AS volume_check_tables_passed,
       v.warned AS volume_check_tables_warned, v.failed AS volume_check_tables_failed
FROM tally t CROSS JOIN volume_totals v"""


# The runs of the daily chain stamp their rows themselves, so that all fall on the
# reported day; the newest run wins.

def restamped(name: str, source: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT * REPLACE (
    {AS_OF} + to_hours(CAST(right(extract_run_id, 1) AS INTEGER)) AS ingested_at)
  FROM {source} WHERE {where}
)"""


SINCE = "extract_run_id = 'run_0' OR date >= DATE '2024-01-08'"
DAILY_SINCE = (
    f"{RAW},{restamped('ran_google', 'raw_google', SINCE)},"
    f"{restamped('ran_meta', 'raw_meta', SINCE)},"
    f"{newest('google', 'ran_google')},{newest('meta', 'ran_meta')},{models('google', 'meta')}"
)

DAILY = (
    f"{RAW},{restamped('ran_google', 'raw_google')},{restamped('ran_meta', 'raw_meta')},"
    f"{newest('google', 'ran_google')},{newest('meta', 'ran_meta')},{models('google', 'meta')},"
    f"{TALLY},{VOLUME}"
)

SPOILT = f"""{ALL_RUNS},
spoilt AS (
  SELECT * REPLACE (
    CASE WHEN clicks % 7 <> 0 THEN campaign_id END AS campaign_id,
    CASE WHEN clicks % 11 = 0 THEN 'other_ads' ELSE platform END AS platform,
    CASE WHEN clicks % 13 = 0 THEN -spend ELSE spend END AS spend,
    CASE WHEN impressions % 5 = 0 THEN ctr + 0.01 WHEN impressions % 3 = 0 THEN ctr + 0.00005
      ELSE ctr END AS ctr)
  FROM mart
)"""


SPOILT_RAW = f"""{RAW},
google AS (SELECT * REPLACE (
  CASE WHEN impressions % 17 <> 0 THEN date END AS date,
  CASE WHEN impressions % 7 <> 0 THEN campaign_id END AS campaign_id,
  CASE WHEN clicks % 5 <> 0 THEN conversions END AS conversions,
  CASE WHEN clicks % 3 <> 0 THEN cost_usd END AS cost_usd) FROM raw_google),
meta AS (SELECT * REPLACE (
  CASE WHEN page_engagement % 19 <> 0 THEN date END AS date,
  CASE WHEN likes % 2 <> 0 THEN campaign_id END AS campaign_id,
  CASE WHEN clicks % 3 <> 0 THEN impressions END AS impressions,
  CASE WHEN shares % 2 <> 0 THEN spend_usd END AS spend_usd) FROM raw_meta),
{models("google", "meta").replace("unified AS (", "whole AS (", 1).replace("FROM unified", "FROM whole")},
unified AS (SELECT * REPLACE (
  CASE WHEN clicks % 6 <> 0 THEN platform END AS platform,
  CASE WHEN clicks % 10 <> 0 THEN campaign_id END AS campaign_id) FROM whole)"""


#: (table, least, most, allowed change in percent): broken low, high, by change, by both, and not.
BROKEN_LIMITS = (
    (S.RAW_GOOGLE_TABLE, 1_000_000_000, 2_000_000_000, 100_000),
    (S.RAW_META_TABLE, 0, 0, 100_000),
    (S.STG_GOOGLE_TABLE, 0, 1_000_000_000, 0),
    (S.STG_META_TABLE, 1_000_000_000, 2_000_000_000, 0),
    (S.MART_TABLE, 0, 1_000_000_000, 100_000),
    ("absent_table", 0, 1, 50),
)


def spoilt_suite() -> str:
    """The declared checks of the mart, over the spoilt one."""
    counts = "\nUNION ALL ".join(
        part
        for part in suite_counts().split("\nUNION ALL ")
        if f"'{S.MART_TABLE}' AS table_name" in part
    )
    return suite(counts.replace("FROM mart", "FROM spoilt"))


BROKEN = volume_of(
    ", ".join(
        f"('{table}', {low}, {high}, {change}, 'seeded')"
        for table, low, high, change in BROKEN_LIMITS[:-1]
    ),
    """UNION ALL SELECT 'absent_table', 'seeded', NULL, NULL, NULL, 'ERROR', 'ERROR', '', '',
    'TABLE_OR_VIEW_NOT_FOUND', 'TABLE_OR_VIEW_NOT_FOUND'""",
)

BY_ACCOUNT = f"date {IN_RANGE}"

COMPARISON = f"""SELECT platform, count(DISTINCT campaign_id) AS nb_campagnes,
       CAST(sum(impressions) AS BIGINT) AS total_impressions,
       {mean("ctr")} AS ctr_moyen, {total("spend")} AS depense_totale"""

REFRESHED = ",".join(
    (
        RAW,
        newest("fresh_google", "raw_google", f"date >= {AS_OF} - 7"),
        newest("fresh_meta", "raw_meta", f"date >= {AS_OF} - 7"),
        f"google AS (SELECT * FROM fresh_google UNION ALL SELECT * FROM raw_google WHERE date < {AS_OF} - 7)",
        f"meta AS (SELECT * FROM fresh_meta UNION ALL SELECT * FROM raw_meta WHERE date < {AS_OF} - 7)",
        models("google", "meta"),
    )
)

#: The stored tables of the ledger's query, by name: day, relation.
LEDGER_TABLES = {
    S.RAW_GOOGLE_TABLE: ("date", "newest_google"),
    S.STG_GOOGLE_TABLE: ("date", "newest_google"),
    S.RAW_META_TABLE: ("date", "raw_meta"),
    S.STG_META_TABLE: ("date", "raw_meta"),
    S.MART_TABLE: ("report_date", "mart"),
}
LEDGER = f"""{REFRESHED},{newest('newest_google', 'raw_google')},
ledger AS ({" UNION ALL ".join(
    f"SELECT '{table}' AS table_name, {day} AS day, CAST(ingested_at AS DATE) AS ingestion_day,"
    f" count(*) AS n FROM {relation} GROUP BY ALL" for table, (day, relation) in LEDGER_TABLES.items())})"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ORACLE: dict[str, str] = {
    # sources
    "google_extract": with_(
        RAW_GOOGLE, f"SELECT {GOOGLE_RECORD} FROM raw_google WHERE date {IN_RANGE}"
    ),
    "meta_extract": with_(RAW_META, f"SELECT {META_RECORD} FROM raw_meta WHERE date {IN_RANGE}"),
    "meta_flatten": with_(FLAT_META, "SELECT * FROM flat_meta"),
    "meta_insights_extract": with_(FLAT_META, f"SELECT * FROM flat_meta WHERE date {IN_RANGE}"),
    "account_records": with_(RAW_GOOGLE, f"SELECT {GOOGLE_RECORD} FROM raw_google"),
    "calendar_scaffold": with_(
        RAW_GOOGLE,
        f"""SELECT campaign_id, campaign_name, date
FROM (SELECT DISTINCT campaign_id, campaign_name FROM raw_google)
CROSS JOIN ({ALL_DAYS} AS date)""",
    ),
    "missing_campaign_days": with_(
        RAW_META,
        f"""SELECT campaign_id, date
FROM (SELECT DISTINCT campaign_id FROM raw_meta) CROSS JOIN ({ALL_DAYS} AS date)
EXCEPT SELECT campaign_id, date FROM raw_meta""",
    ),
    "missing_from_dimension": with_(
        RAW_GOOGLE,
        f"""SELECT 'camp_' || c_custkey AS campaign_id, date
FROM customer CROSS JOIN ({ALL_DAYS} AS date)
EXCEPT SELECT campaign_id, date FROM raw_google""",
    ),
    "missing_runs": with_(
        f"""{RAW_META}, absent AS (SELECT campaign_id, date
FROM (SELECT DISTINCT campaign_id FROM raw_meta) CROSS JOIN ({ALL_DAYS} AS date)
EXCEPT SELECT campaign_id, date FROM raw_meta)""",
        """SELECT campaign_id, min(date) AS from_day, max(date) AS to_day FROM (
  SELECT *, date - CAST(row_number() OVER (PARTITION BY campaign_id ORDER BY date) AS INTEGER) AS run
  FROM absent) GROUP BY campaign_id, run""",
    ),
    "missing_days_unrolled": with_(
        RAW_META,
        f"""SELECT campaign_id, date
FROM (SELECT DISTINCT campaign_id FROM raw_meta) CROSS JOIN ({ALL_DAYS} AS date)
EXCEPT SELECT campaign_id, date FROM raw_meta""",
    ),
    # raw zone
    "restated_bucketed": with_(
        f"{RAW_GOOGLE},{newest('fresh', 'raw_google', f'date >= {AS_OF} - 7')}",
        f"SELECT * FROM fresh UNION ALL SELECT * FROM raw_google WHERE date < {AS_OF} - 7",
    ),
    "ingestion_metadata": with_(
        RAW_GOOGLE,
        f"""SELECT {GOOGLE_RECORD}, {INGESTED_AT} AS ingested_at,
       'run_fixed' AS extract_run_id, 'google_ads' AS source FROM raw_google""",
    ),
    "widened_batches": with_(
        RAW_GOOGLE,
        """SELECT CAST(date AS VARCHAR) AS date, campaign_id,
  CASE WHEN extract_run_id = 'run_1' THEN clicks * 3000000000 ELSE clicks END AS clicks,
  CASE WHEN extract_run_id = 'run_1' THEN cost_usd ELSE floor(cost_usd) END AS cost,
  CASE extract_run_id WHEN 'run_0' THEN CAST(clicks AS VARCHAR) WHEN 'run_2' THEN 'n/a' END AS note,
  CASE WHEN extract_run_id = 'run_2' THEN CAST(impressions AS INTEGER) END AS extra FROM raw_google""",
    ),
    "raw_append": with_(RAW_GOOGLE, "SELECT * FROM raw_google"),
    "raw_backfill": with_(
        FLAT_META,
        f"""SELECT {META_RECORD}, {INGESTED_AT} AS ingested_at,
       'backfill' AS extract_run_id, 'meta_ads' AS source FROM flat_meta""",
    ),
    "raw_replace_days": with_(
        f"{RAW_GOOGLE},{newest('fresh', 'raw_google', f'date >= {AS_OF} - 7')}",
        f"""SELECT * FROM fresh
UNION ALL SELECT * FROM raw_google WHERE date < {AS_OF} - 7 AND extract_run_id <> 'run_2'""",
    ),
    "raw_rewrite": with_(
        f"{RAW_GOOGLE},{newest('google', 'raw_google')}", "SELECT * FROM google"
    ),
    "dedup_google": with_(
        f"{RAW_GOOGLE},{newest('google', 'raw_google')}", "SELECT * FROM google"
    ),
    "dedup_meta": with_(f"{RAW_META},{newest('meta', 'raw_meta')}", "SELECT * FROM meta"),
    "late_window": with_(
        RAW_META, f"SELECT * FROM raw_meta WHERE date BETWEEN {AS_OF} - 7 AND {AS_OF}"
    ),
    "late_restatement": with_(
        f"{RAW_GOOGLE},{newest('fresh', 'raw_google', f'date BETWEEN {AS_OF} - 7 AND {AS_OF}')}",
        "SELECT * FROM fresh",
    ),
    "ingestion_profile": with_(
        RAW,
        "\nUNION ALL ".join(
            f"""SELECT count(*) AS row_count, min(date) AS first_date, max(date) AS last_date,
       count(DISTINCT campaign_id) AS unique_campaigns,
       coalesce({total(spend)}, 0.0) AS total_spend, '{source}' AS source FROM {relation}"""
            for relation, spend, source in (
                ("raw_google", "cost_usd", "google_ads"),
                ("raw_meta", "spend_usd", "meta_ads"),
            )
        ),
    ),
    "stream_ingest": with_(
        FLAT_META,
        f"SELECT *, {INGESTED_AT} AS ingested_at, 'meta_ads' AS source FROM flat_meta",
    ),
    "stream_newest": with_(
        f"{RAW_META},{newest('meta', 'raw_meta')}",
        "SELECT * REPLACE (CAST(campaign_id AS VARCHAR) AS campaign_id) FROM meta",
    ),
    # models
    "stg_google": with_(ALL_RUNS, "SELECT * FROM stg_google"),
    "stg_meta": with_(ALL_RUNS, "SELECT * FROM stg_meta"),
    "typed_staging": with_(RAW_GOOGLE, f"SELECT {GOOGLE_RECORD} FROM raw_google"),
    "quality_flags": with_(
        ALL_RUNS,
        """SELECT report_date, campaign_id, platform, extract_run_id, impressions, clicks,
       CASE WHEN clicks > impressions THEN TRUE ELSE FALSE END AS is_invalid_clicks
FROM unified""",
    ),
    "unified": with_(ALL_RUNS, "SELECT * FROM unified"),
    "unified_latest": with_(
        f"{ALL_RUNS},{newest('kept', 'unified', keys='report_date, campaign_id, platform')}",
        "SELECT * FROM kept",
    ),
    "mart": with_(MODELS, "SELECT * FROM mart"),
    "mart_table": with_(MODELS, "SELECT * FROM mart"),
    "mart_swapped": with_(MODELS, "SELECT * FROM mart"),
    "mart_refreshed": with_(REFRESHED, "SELECT * FROM mart"),
    "mart_by_sql": with_(
        MODELS,
        f"""SELECT report_date, platform, count(*) AS campaigns,
       CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
       count(ctr) AS with_ctr, max(cpc) AS max_cpc
FROM mart WHERE report_date >= {AS_OF} - 7 GROUP BY report_date, platform""",
    ),
    "kpi_targets": with_(
        MODELS,
        """SELECT report_date, campaign_id, platform, ctr > 0.02 AS meets_ctr_target,
       cpa < 5 AS meets_cpa_target, conversion_rate > 0.05 AS meets_conversion_rate_target
FROM mart""",
    ),
    # analysis
    "top_roas": with_(
        MODELS,
        f"""SELECT campaign_name, platform, {total("spend")} AS total_spend,
       CAST(sum(conversions) AS BIGINT) AS total_conversions,
       {rounded(mean("roas"), 4)} AS avg_roas
FROM mart WHERE report_date >= {AS_OF} - 30
GROUP BY campaign_name, platform HAVING sum(conversions) > 0
ORDER BY avg_roas DESC NULLS LAST, campaign_name, platform LIMIT 10""",
    ),
    "platform_comparison": with_(
        MODELS,
        f"""{COMPARISON}, {rounded(mean("cpa"), 2)} AS cpa_moyen,
       {rounded(mean("roas"), 4)} AS roas_moyen
FROM mart WHERE report_date >= {AS_OF} - 7 GROUP BY platform""",
    ),
    "daily_trend": with_(
        MODELS,
        f"""SELECT report_date, campaign_name, impressions, clicks, ctr, spend, conversions,
       cpa, roas
FROM mart WHERE campaign_name = 'Campaign 7' AND report_date >= {AS_OF} - 30
ORDER BY report_date DESC""",
    ),
    "efficiency_bands": with_(
        MODELS,
        f"""SELECT campaign_name, platform,
       CASE WHEN roas >= 3 THEN 'Excellent' WHEN roas >= 2 THEN 'Bon'
            WHEN roas >= 1 THEN 'Acceptable' ELSE 'À Améliorer' END AS notation_efficacite,
       {rounded("roas", 4)} AS roas, {rounded("cpa", 2)} AS cpa
FROM mart WHERE report_date = {AS_OF} - 1""",
    ),
    "top_spend": with_(
        MODELS,
        f"""SELECT campaign_name, platform, {total("spend")} AS total_spend,
       {mean("roas")} AS avg_roas
FROM mart WHERE report_date >= {AS_OF} - 30 GROUP BY campaign_name, platform
ORDER BY total_spend DESC NULLS LAST, campaign_name, platform LIMIT 10""",
    ),
    "platform_comparison_raw": with_(
        MODELS,
        f"""{COMPARISON}, {mean("roas")} AS roas_moyen
FROM mart WHERE report_date >= {AS_OF} - 7 GROUP BY platform""",
    ),
    "rollup_top_roas": with_(
        MODELS,
        f"""SELECT campaign_name, platform, {total("spend")} AS total_spend,
       CAST(sum(conversions) AS BIGINT) AS total_conversions,
       {rounded(mean("roas"), 4)} AS avg_roas
FROM mart WHERE report_date >= {AS_OF} - 20
GROUP BY campaign_name, platform HAVING sum(conversions) > 0
ORDER BY avg_roas DESC NULLS LAST, campaign_name, platform LIMIT 10""",
    ),
    "rollup_top_spend": with_(
        MODELS,
        f"""SELECT campaign_name, platform, {total("spend")} AS total_spend,
       {mean("roas")} AS avg_roas
FROM mart WHERE report_date >= {AS_OF} - 20 GROUP BY campaign_name, platform
ORDER BY total_spend DESC NULLS LAST, campaign_name, platform LIMIT 10""",
    ),
    "rollup_platform_comparison": with_(
        MODELS,
        f"""{COMPARISON}, {rounded(mean("cpa"), 2)} AS cpa_moyen,
       {rounded(mean("roas"), 4)} AS roas_moyen
FROM mart WHERE report_date >= {AS_OF} - 7 GROUP BY platform""",
    ),
    "rollup_platform_comparison_raw": with_(
        MODELS,
        f"""{COMPARISON}, {mean("roas")} AS roas_moyen
FROM mart WHERE report_date >= {AS_OF} - 7 GROUP BY platform""",
    ),
    "rollup_rolling_campaigns": with_(
        MODELS,
        """SELECT d.report_date AS as_of, m.platform, count(DISTINCT campaign_id) AS nb_campagnes
FROM (SELECT DISTINCT report_date FROM mart) d
JOIN mart m ON m.report_date BETWEEN d.report_date - 7 AND d.report_date GROUP BY ALL""",
    ),
    # quality
    "dq_not_null": with_(MODELS, statuses(not_null_counts())),
    "dq_accepted_values": with_(MODELS, statuses(accepted_counts())),
    "dq_duplicate_grain": with_(
        ALL_RUNS,
        """SELECT report_date, campaign_id, platform, count(*) AS n_records FROM unified
GROUP BY report_date, campaign_id, platform HAVING count(*) > 1""",
    ),
    "dq_clicks_not_exceeding_impressions": with_(
        MODELS, all_violations("clicks_not_exceeding_impressions", ", impressions, clicks")
    ),
    "dq_clicks_all_runs": with_(
        ALL_RUNS, all_violations("clicks_not_exceeding_impressions", ", impressions, clicks")
    ),
    "dq_clicks_newest": with_(
        ALL_RUNS,
        all_violations("clicks_not_exceeding_impressions", ", impressions, clicks")
        + " ORDER BY report_date DESC, platform, campaign_id, ingested_at DESC LIMIT 1000",
    ),
    "dq_ctr_not_exceeding_100_percent": with_(
        MODELS, all_violations("ctr_not_exceeding_100_percent", ", clicks, impressions, ctr")
    ),
    "dq_kpi_calculations": with_(MODELS, all_violations("kpi_calculations", "")),
    "dq_no_negative_metrics": with_(
        MODELS,
        all_violations("no_negative_metrics", ", impressions, clicks, spend, conversions"),
    ),
    "dq_accepted_range": with_(MODELS, accepted_range()),
    "dq_recency": with_(
        MODELS,
        f"""SELECT max(report_date) AS newest_report_date,
       CASE WHEN max(report_date) >= {AS_OF} - 7 THEN 'PASS' ELSE 'FAIL' END AS status
FROM mart""",
    ),
    "dq_suite": with_(MODELS, suite(suite_counts())),
    "dq_suite_by_table": with_(MODELS, suite(suite_counts())),
    "digest_days": with_(
        ALL_RUNS,
        """SELECT report_date AS day, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, max(n) > 1 AS repeated
FROM (SELECT report_date, campaign_id, platform, count(*) AS n FROM unified GROUP BY ALL) GROUP BY 1""",
    ),
    "digest_duplicates": with_(
        ALL_RUNS,
        """SELECT report_date, campaign_id, platform, count(*) AS n_records FROM unified
GROUP BY report_date, campaign_id, platform HAVING count(*) > 1""",
    ),
    "dq_tally": with_(f"{MODELS},{TALLY}", "SELECT * FROM tally"),
    # volume
    "ingestion_day_counts": with_(
        MODELS, f"SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({day_counts(AS_OF)})"
    ),
    "volume_checks": with_(f"{MODELS},{VOLUME}", "SELECT * FROM volume"),
    "volume_checks_by_table": with_(f"{MODELS},{VOLUME}", "SELECT * FROM volume"),
    "volume_summary": with_(f"{MODELS},{VOLUME}", "SELECT * FROM volume_totals"),
    "volume_report": with_(
        f"{MODELS},{VOLUME}",
        """SELECT 'summary' AS section, CAST(NULL AS VARCHAR) AS table_name,
       overall_status AS status,
       printf('%d PASS, %d WARN, %d FAIL, %d ERROR', passed, warned, failed, errored) AS result,
       '' AS issues FROM volume_totals
UNION ALL
SELECT 'table', table_name, status,
       'Today: ' || today_count || ' | Yesterday: ' || yesterday_count
         || ' | Variance: ' || CAST(variance_percent AS VARCHAR) || '%', issues FROM volume
UNION ALL SELECT 'warning', table_name, NULL, warnings, '' FROM volume WHERE warnings <> ''
UNION ALL SELECT 'error', table_name, NULL, errors, '' FROM volume WHERE errors <> ''""",
    ),
    "volume_history": with_(
        MODELS,
        f"""SELECT *, CAST(printf('%.2f', CASE WHEN previous_count > 0
         THEN CAST(abs(row_count - previous_count) AS DOUBLE) / previous_count * 100
         ELSE 0.0 END) AS DOUBLE) AS variance_percent
FROM (
  SELECT source, day, coalesce(n, 0) AS row_count,
         lag(coalesce(n, 0)) OVER (PARTITION BY source ORDER BY day) AS previous_count
  FROM (SELECT DISTINCT source FROM mart) CROSS JOIN ({ALL_DAYS} AS day)
  LEFT JOIN (SELECT source, CAST(ingested_at AS DATE) AS day, count(*) AS n
             FROM mart GROUP BY 1, 2) USING (source, day)
)""",
    ),
    "ledger_audit": with_(
        LEDGER,
        """SELECT table_name, day, ingestion_day, n AS ledger_rows, n AS stored_rows, false AS differ
FROM ledger""",
    ),
    "ledger_volumes": with_(
        LEDGER,
        f"""SELECT *, CAST(printf('%.2f', CASE WHEN previous_count > 0
         THEN CAST(abs(row_count - previous_count) AS DOUBLE) / previous_count * 100
         ELSE 0.0 END) AS DOUBLE) AS variance_percent
FROM (
  SELECT table_name, day, coalesce(n, 0) AS row_count,
         lag(coalesce(n, 0)) OVER (PARTITION BY table_name ORDER BY day) AS previous_count
  FROM (SELECT DISTINCT table_name FROM ledger) CROSS JOIN ({ALL_DAYS} AS day)
  LEFT JOIN (SELECT table_name, ingestion_day AS day, CAST(sum(n) AS BIGINT) AS n
             FROM ledger WHERE ingestion_day {"BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"}
             GROUP BY 1, 2) USING (table_name, day)
)""",
    ),
    # broken rules
    "dq_spoilt_suite": with_(SPOILT, spoilt_suite()),
    "dq_spoilt_not_null": with_(SPOILT_RAW, statuses(c for c in not_null_counts() if "mart" not in c)),
    "dq_stale_recency": with_(
        MODELS,
        f"""SELECT n AS days_ago, max(report_date) AS newest_report_date,
  CASE WHEN max(report_date) >= {AS_OF} - 7 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (VALUES (8), (7), (400)) AS v(n) LEFT JOIN mart ON report_date <= {AS_OF} - n GROUP BY n""",
    ),
    "dq_spoilt_kpis": with_(
        SPOILT, all_violations("kpi_calculations", "").replace("FROM mart", "FROM spoilt")
    ),
    "dq_spoilt_negatives": with_(
        SPOILT,
        all_violations(
            "no_negative_metrics", ", impressions, clicks, spend, conversions"
        ).replace("FROM mart", "FROM spoilt"),
    ),
    "dq_spoilt_range": with_(SPOILT, accepted_range().replace("FROM mart", "FROM spoilt")),
    "volume_broken": with_(f"{MODELS},{BROKEN}", "SELECT * FROM volume"),
    "volume_broken_summary": with_(f"{MODELS},{BROKEN}", "SELECT * FROM volume_totals"),
    "volume_broken_report": with_(
        f"{MODELS},{BROKEN}",
        """SELECT 'summary' AS section, CAST(NULL AS VARCHAR) AS table_name,
       overall_status AS status,
       printf('%d PASS, %d WARN, %d FAIL, %d ERROR', passed, warned, failed, errored) AS result,
       '' AS issues FROM volume_totals
UNION ALL
SELECT 'table', table_name, status, CASE WHEN error IS NULL THEN
       'Today: ' || today_count || ' | Yesterday: ' || yesterday_count
         || ' | Variance: ' || CAST(variance_percent AS VARCHAR) || '%'
       ELSE 'Error: ' || error END, issues FROM volume
UNION ALL SELECT 'warning', table_name, NULL, warnings, '' FROM volume WHERE warnings <> ''
UNION ALL SELECT 'error', table_name, NULL, errors, '' FROM volume WHERE errors <> ''""",
    ),
    "meta_flatten_repeated": with_(
        FLAT_META,
        """SELECT * REPLACE (10 * likes AS likes, 10 * comments AS comments, 10 * shares AS shares,
  10 * video_views AS video_views) FROM flat_meta""",
    ),
    "typed_lenient": with_(
        RAW_GOOGLE,
        f"""SELECT {GOOGLE_RECORD} FROM (SELECT * REPLACE (
  CASE WHEN impressions % 7 <> 0 THEN clicks END AS clicks) FROM raw_google)""",
    ),
    "google_array_files": with_(
        RAW_GOOGLE,
        f"""SELECT date, campaign_id, campaign_name, impressions, clicks, cost_usd,
  clicks % 9 AS conversions FROM raw_google WHERE {BY_ACCOUNT}""",
    ),
    "meta_array_files": with_(
        RAW_META,
        f"""SELECT date, CAST(campaign_id AS VARCHAR) AS campaign_id, campaign_name, impressions,
  clicks, spend_usd, clicks % 9 AS conversions FROM raw_meta WHERE {BY_ACCOUNT}""",
    ),
    "stream_and_batch": with_(
        FLAT_META,
        f"""SELECT * EXCLUDE (conversions) FROM (SELECT {META_RECORD},
  CASE WHEN date >= DATE '2024-01-08' THEN {INGESTED_AT} + INTERVAL 1 DAY ELSE {INGESTED_AT} END
    AS ingested_at, 'meta_ads' AS source FROM flat_meta)""",
    ),
    "catalog_inventory": with_(
        RAW_GOOGLE,
        f"""SELECT '{S.RAW_GOOGLE_TABLE}' AS table_name, count(*) AS row_count,
  false AS is_empty, true AS size_agrees FROM raw_google
UNION ALL SELECT '{S.RAW_META_TABLE}', 0, true, true""",
    ),
    "inventory_by_day": with_(
        REFRESHED, "SELECT report_date AS day, count(*) AS row_count, true AS has_files FROM mart GROUP BY 1"
    ),
    # run log and catalog
    "run_summary": with_(
        f"{MODELS},{TALLY},{VOLUME}",
        run_row(
            "run_fixed", "2024-01-30 05:00:00", "2024-01-30 05:02:03.6", 123,
            "SELECT count(*) FROM google", "SELECT count(*) FROM meta",
        ),
    ),
    "recent_runs": with_(
        ALL_RUNS,
        """SELECT strftime(ingested_at, 'run-%Y%m%d%H') AS run_id, 'campaign_daily' AS dag_id,
       CAST(ingested_at AS DATE) AS run_date, ingested_at AS execution_date,
       CAST(60 AS BIGINT) AS duration_seconds, 'success' AS status,
       CASE WHEN count(*) FILTER (WHERE platform = 'google_ads') > 0
         THEN 'success' ELSE 'empty' END AS google_ads_status,
       'success' AS meta_ads_status, 'not_run' AS dbt_test_status,
       'not_run' AS volume_check_status
FROM unified GROUP BY ingested_at ORDER BY ingested_at DESC LIMIT 10""",
    ),
    "daily_run": with_(
        DAILY,
        run_row(
            "daily_2", "2024-01-30 02:00:00", "2024-01-30 02:01:30", 90,
            "SELECT count(*) FROM raw_google WHERE extract_run_id = 'run_2'",
            "SELECT count(*) FROM raw_meta WHERE extract_run_id = 'run_2'",
        ),
    ),
    "event_times": """SELECT event_id, date_trunc('millisecond', ts) AS at,
  strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS at_text,
  round(event_id * 4096 / 1048576, 2) AS size_mb FROM events""",
    "daily_mart_since": with_(DAILY_SINCE, """SELECT * EXCLUDE (mart_created_at)
  REPLACE (replace(extract_run_id, 'run_', 'daily_') AS extract_run_id) FROM mart"""),
    "table_inventory": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty FROM {t}"
        for t in TABLES
    ),
}
