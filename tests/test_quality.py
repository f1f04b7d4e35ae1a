import datetime as dt

import pytest
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.operators import quality, volume
from adloom.plans import mart, staging, suite, unified
from conftest import values

DAY = dt.date(2024, 1, 5)
NOW = dt.datetime(2024, 1, 6)


def unified_rows(frame, *changes):
    base = {
        "report_date": DAY, "campaign_id": "c", "campaign_name": "C", "impressions": 100,
        "clicks": 10, "conversions": 2, "spend": 5.0, "likes": None, "comments": None,
        "shares": None, "video_views": None, "page_engagement": None, "ingested_at": NOW,
        "extract_run_id": "a", "source": S.GOOGLE, "platform": S.GOOGLE,
    }
    rows = [{**base, "campaign_id": f"c{i}", **c} for i, c in enumerate(changes)]
    return frame([tuple(r[n] for n in S.UNIFIED.names) for r in rows], S.UNIFIED)


def mart_of(frame, *changes):
    return mart.build_mart(unified_rows(frame, *changes), "2024-02-01T00:00:00Z")


def result(df, check):
    return {r["check_name"]: (r["violations"], r["status"]) for r in df.collect()}[check]


def test_declared_checks_number_thirty_six():
    not_null = sum(len(c) for c in quality.NOT_NULL.values())
    total = not_null + len(quality.ACCEPTED_PLATFORMS) + len(quality.UNIQUE_GRAIN) + len(quality.MART_TESTS)
    assert (not_null, total) == (28, 36)


@pytest.mark.parametrize(
    "change, violated",
    [
        ({}, set()),
        ({"clicks": 101}, {"clicks_not_exceeding_impressions", "ctr_not_exceeding_100_percent"}),
        ({"clicks": 5, "impressions": 0}, {"clicks_not_exceeding_impressions"}),
        ({"impressions": -1, "clicks": -2}, {"no_negative_metrics"}),
        ({"spend": -0.01}, {"no_negative_metrics"}),
        ({"conversions": -1}, {"no_negative_metrics"}),
        ({"clicks": None}, {"not_null_clicks"}),
        ({"spend": None}, {"not_null_spend"}),
        ({"platform": "other_ads"}, {"accepted_values_platform"}),
    ],
)
def test_each_seeded_violation_is_found(frame, change, violated):
    got = quality.run_suite({S.MART_TABLE: mart_of(frame, {}, change)})
    failing = {r["check_name"] for r in got.where("status = 'FAIL'").collect()}
    assert failing == violated
    assert got.count() == len(quality.row_checks(S.MART_TABLE)) + 1


def test_unknown_platform_is_a_violation_but_null_is_not(frame):
    union = unified_rows(frame, {}, {"platform": None}, {"platform": "tv"})
    got = quality.accepted_values_suite({S.UNIFIED_TABLE: union})
    assert values(got) == [(S.UNIFIED_TABLE, "accepted_values_platform", 1, "FAIL")]


def test_repeated_grain(frame):
    union = unified_rows(frame, {"campaign_id": "x"}, {"campaign_id": "x"}, {"campaign_id": "y"})
    assert values(quality.duplicate_grain(union)) == [(DAY, "x", S.GOOGLE, 2)]
    results = quality.run_suite({S.UNIFIED_TABLE: union})
    assert result(results, "unique_combination_grain") == (1, "FAIL")


def test_missing_keys_in_raw(frame):
    raw = frame([(None, "c"), (DAY, None), (DAY, "c")], "date date, campaign_id string")
    got = quality.not_null_suite({S.RAW_GOOGLE_TABLE: raw})
    assert values(got, "check_name", "violations") == [("not_null_campaign_id", 1), ("not_null_date", 1)]


@pytest.mark.parametrize("kpi, wrong, tolerance", [("ctr", 0.2, 0.0001), ("cpc", 0.9, 0.01), ("cpa", 9.0, 0.01)])
def test_stored_kpis_are_recomputed(frame, kpi, wrong, tolerance):
    good = mart_of(frame, {})
    check = quality.mart_test("kpi_calculations")
    assert quality.violations(good, check).count() == 0
    assert quality.violations(good.withColumn(kpi, F.lit(wrong)), check).count() == 1
    close = good.withColumn(kpi, F.col(kpi) + tolerance / 2)
    assert quality.violations(close, check).count() == 0


def test_unchecked_kpis_and_missing_kpis_do_not_count(frame):
    good = mart_of(frame, {})
    check = quality.mart_test("kpi_calculations")
    changed = good.withColumns({"roas": F.lit(99.0), "conversion_rate": F.lit(99.0)})
    assert quality.violations(changed, check).count() == 0
    assert quality.violations(good.withColumn("ctr", F.lit(None).cast("double")), check).count() == 0


def test_the_report_lists_the_newest_violations(frame):
    rows = [{"clicks": 101, "report_date": DAY + dt.timedelta(days=i % 5)} for i in range(20)]
    got = quality.violations(mart_of(frame, *rows), quality.mart_test("clicks_not_exceeding_impressions"), 4)
    assert [r["report_date"] for r in got.collect()] == [DAY + dt.timedelta(days=4)] * 4
    assert got.columns == ["report_date", "campaign_id", "platform", "impressions", "clicks"]


def test_the_report_is_a_top_k_not_a_window(frame):
    got = quality.violations(mart_of(frame, {}), quality.mart_test("no_negative_metrics"), 1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_suite_counts_all_violations_and_caps_the_report(spark):
    many = spark.range(1500).select(
        F.lit(DAY).alias("report_date"), F.col("id").cast("string").alias("campaign_id"),
        F.lit("C").alias("campaign_name"), F.lit(1).cast("long").alias("impressions"),
        F.lit(2).cast("long").alias("clicks"), F.lit(1).cast("long").alias("conversions"),
        F.lit(1.0).alias("spend"),
        *(F.lit(None).cast("long").alias(c) for c in S.ENGAGEMENT_ACTIONS),
        F.lit(NOW).alias("ingested_at"), F.lit("a").alias("extract_run_id"),
        F.lit(S.GOOGLE).alias("source"), F.lit(S.GOOGLE).alias("platform"),
    )
    results = quality.run_suite({S.MART_TABLE: mart.build_mart(many, "2024-02-01T00:00:00Z")})
    row = results.where("check_name = 'clicks_not_exceeding_impressions'").first()
    assert (row["violations"], row["reported_rows"]) == (1500, 1000)


def test_row_checks_share_one_aggregation(frame):
    got = quality.count_violations(mart_of(frame, {}), quality.row_checks(S.MART_TABLE))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_tally(frame):
    results = frame([("PASS",), ("PASS",), ("FAIL",), ("WARN",)], "status string")
    assert tuple(quality.tally(results).first()) == (4, 2, 1, 1)


def test_accepted_range(frame):
    got = quality.accepted_range(mart_of(frame, {"spend": -1.0}, {}))
    assert result(got, "accepted_range_spend") == (1, "FAIL")
    assert result(got, "accepted_range_clicks") == (0, "PASS")
    assert got.count() == 9


@pytest.mark.parametrize("as_of, status", [("2024-01-12", "PASS"), ("2024-01-13", "FAIL")])
def test_recency(frame, as_of, status):
    row = quality.recency(mart_of(frame, {}), as_of).first()
    assert (row["newest_report_date"], row["status"]) == (DAY, status)


def test_recency_of_an_empty_mart_fails(frame):
    assert quality.recency(mart_of(frame, {}).where("false"), "2024-01-12").first()["status"] == "FAIL"


def test_suite_over_all_tables_is_clean_for_clean_data(frame):
    ddl = ("date date, campaign_id string, campaign_name string, impressions long, clicks long,"
           " {cost} double, ingested_at timestamp, extract_run_id string, source string{more}")
    g = frame([(DAY, "g", "G", 100, 10, 5.0, NOW, "a", S.GOOGLE, 2)],
              ddl.format(cost="cost_usd", more=", conversions long"))
    m = frame([(DAY, "m", "M", 100, 10, 5.0, NOW, "a", S.META, 1, 1, 1)],
              ddl.format(cost="spend_usd", more=", likes long, comments long, shares long"))
    stg_g, stg_m = staging.stage_google(g), staging.stage_meta(m)
    union = unified.unify(stg_g, stg_m)
    got = quality.run_suite({
        S.RAW_GOOGLE_TABLE: g, S.RAW_META_TABLE: m, S.STG_GOOGLE_TABLE: stg_g,
        S.STG_META_TABLE: stg_m, S.UNIFIED_TABLE: union,
        S.MART_TABLE: mart.build_mart(union, "2024-02-01T00:00:00Z"),
    })
    assert tuple(quality.tally(got).first()) == (36, 36, 0, 0)


def test_the_model_suite_equals_the_suite_by_table(spark, frame):
    g = frame(
        [(DAY, "g", "G", 100, 10, 5.0, NOW, "a", S.GOOGLE, None),
         (DAY, "g", "G", None, 10, None, NOW, "a", S.GOOGLE, 2),
         (None, "g", "G", None, 10, None, NOW, "a", S.GOOGLE, 2),
         (DAY, None, "G", 1, 10, 1.0, NOW, "a", S.GOOGLE, 2)],
        "date date, campaign_id string, campaign_name string, impressions long, clicks long,"
        " cost_usd double, ingested_at timestamp, extract_run_id string, source string,"
        " conversions long")
    m = frame(
        [(DAY, 1, "M", 100, None, None, NOW, "a", S.META, 1, 1, 1), (None, None, "M", 1, 2, -3.0, NOW, "a", S.META, 1, 1, 1)],
        "date date, campaign_id long, campaign_name string, impressions long, clicks long,"
        " spend_usd double, ingested_at timestamp, extract_run_id string, source string,"
        " likes long, comments long, shares long")
    stg_g, stg_m = staging.stage_google(g), staging.stage_meta(m)
    union = unified.unify(stg_g, stg_m)
    built = mart.build_mart(union, "2024-02-01T00:00:00Z")
    by_table = quality.run_suite({
        S.RAW_GOOGLE_TABLE: g, S.RAW_META_TABLE: m, S.STG_GOOGLE_TABLE: stg_g,
        S.STG_META_TABLE: stg_m, S.UNIFIED_TABLE: union, S.MART_TABLE: built,
    })
    fused = suite.run_model_suite(g, m, built)
    columns = ("table_name", "check_name", "violations", "status", "reported_rows")
    assert values(fused, *columns) == values(by_table, *columns)
    assert fused.where("status = 'FAIL'").count() > 10

    frames = {S.RAW_GOOGLE_TABLE: g, S.RAW_META_TABLE: m, S.STG_GOOGLE_TABLE: stg_g,
              S.STG_META_TABLE: stg_m, S.MART_TABLE: built}
    columns = ("table_name", "today_count", "yesterday_count", "error")
    for as_of in ("2024-01-06", "2024-01-07"):
        together = suite.model_day_counts(g, m, built, as_of)
        one_by_one = volume.counts_by_table(spark, frames, as_of)
        assert values(together, *columns) == values(one_by_one, *columns)
