import datetime as dt

from pyspark.sql import functions as F

from adloom import schemas as S
from adloom.operators.latest import latest_per_key, latest_raw, latest_unified, late_window, restate
from adloom.plans import mart, staging, unified
from conftest import values

DAY = dt.date(2024, 1, 5)


def instant(hour):
    return dt.datetime(2024, 1, 6, hour)


def google(frame, *rows):
    ddl = ("date date, campaign_id string, campaign_name string, impressions long, clicks long,"
           " conversions long, cost_usd double, ingested_at timestamp, extract_run_id string,"
           " source string")
    return frame([(*r, S.GOOGLE) for r in rows], ddl)


def meta(frame, *rows):
    ddl = ("date date, campaign_id long, campaign_name string, impressions long, clicks long,"
           " conversions long, spend_usd double, likes long, comments long, shares long,"
           " ingested_at timestamp, extract_run_id string, source string")
    return frame([(*r, S.META) for r in rows], ddl)


def sample(frame):
    g = google(
        frame,
        (DAY, "g1", "G", 100, 10, 2, 5.0, instant(1), "a"),
        (None, "g2", "G", 100, 10, 2, 5.0, instant(1), "a"),
        (DAY, None, "G", 100, 10, 2, 5.0, instant(1), "a"),
    )
    m = meta(frame, (DAY, 7, "M", 200, 4, 9, 8.0, 1, 2, 3, instant(1), "a"))
    return g, m


def test_staging_requires_the_key_and_keeps_the_listed_columns(frame):
    g, m = sample(frame)
    stg_g, stg_m = staging.stage_google(g), staging.stage_meta(m)
    assert tuple(stg_g.columns) == S.STG_GOOGLE_COLUMNS and stg_g.count() == 1
    assert tuple(stg_m.columns) == S.STG_META_COLUMNS
    assert "conversions" not in stg_m.columns
    assert values(stg_m, "video_views", "page_engagement") == [(None, None)]


def test_union_has_both_branches_in_one_schema(frame):
    g, m = sample(frame)
    got = unified.unify(staging.stage_google(g), staging.stage_meta(m))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in S.UNIFIED]
    rows = {r["platform"]: r for r in got.collect()}
    assert rows[S.META]["campaign_id"] == "7" and rows[S.META]["conversions"] is None
    assert rows[S.GOOGLE]["likes"] is None and rows[S.GOOGLE]["spend"] == 5.0
    assert rows[S.META]["spend"] == 8.0


def test_meta_conversions_are_null_even_if_staging_held_them(frame):
    _, m = sample(frame)
    branch = unified.Branch(
        S.META, m.withColumnRenamed("date", "report_date"), {"spend": "spend_usd"},
        frozenset({"conversions"}),
    )
    assert values(branch.to_unified(), "conversions") == [(None,)]


def test_a_third_platform_is_one_more_branch(frame):
    g, m = sample(frame)
    third = staging.stage_google(g).withColumnRenamed("cost_usd", "spend")
    got = unified.unify_branches(
        [unified.Branch(S.GOOGLE, staging.stage_google(g), {"spend": "cost_usd"}),
         unified.Branch("other_ads", third)]
    )
    assert values(got, "platform", "spend") == [("google_ads", 5.0), ("other_ads", 5.0)]


def test_mart_columns_and_key_filter(frame):
    g, m = sample(frame)
    union = unified.unify(staging.stage_google(g), staging.stage_meta(m))
    got = mart.build_mart(union.unionByName(union.withColumn("platform", F.lit(None).cast("string"))),
                          "2024-02-01T00:00:00Z")
    assert got.columns == S.MART.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in S.MART]
    assert got.count() == 2
    assert values(got, "platform", "ctr", "cpa", "roas", "cpc", "conversion_rate") == [
        ("google_ads", 0.1, 2.5, 0.4, 0.5, 0.2), ("meta_ads", 0.02, None, None, 2.0, None),
    ]


def test_mart_timestamp_defaults_to_now(frame):
    g, m = sample(frame)
    created = mart.mart_from_raw(g, m).select("mart_created_at").distinct().collect()
    assert len(created) == 1 and created[0][0] is not None


def test_latest_row_wins_and_dedup_is_idempotent(frame):
    g = google(
        frame,
        (DAY, "g1", "old", 1, 1, 1, 1.0, instant(1), "a"),
        (DAY, "g1", "new", 2, 2, 2, 2.0, instant(3), "b"),
        (DAY, "g1", "mid", 3, 3, 3, 3.0, instant(2), "c"),
        (DAY, "g2", "only", 4, 4, 4, 4.0, instant(1), "a"),
    )
    once = latest_raw(g)
    assert values(once, "campaign_id", "campaign_name") == [("g1", "new"), ("g2", "only")]
    assert values(latest_raw(once)) == values(once)
    assert once.columns == g.columns


def test_null_keys_form_one_group(frame):
    g = google(
        frame,
        (None, None, "x", 1, 1, 1, 1.0, instant(1), "a"),
        (None, None, "y", 1, 1, 1, 1.0, instant(2), "a"),
    )
    assert values(latest_raw(g), "campaign_name") == [("y",)]


def test_settled_ties_are_the_same_for_any_input_order(frame):
    rows = [(DAY, "g1", f"n{i}", i, i, i, 1.0, instant(1), "a") for i in range(50)]
    first = latest_raw(google(frame, *rows), settle_ties=True)
    second = latest_raw(google(frame, *rows[::-1]).repartition(4), settle_ties=True)
    assert values(first) == values(second)


def test_a_dominant_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(40000).select(
        F.lit(DAY).alias("date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("campaign_id"),
        F.timestamp_seconds("id").alias("ingested_at"),
        F.lit("a").alias("extract_run_id"),
    )
    kept = latest_raw(hot)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert kept.count() == 40000 - 13334 + 1
    assert values(kept.where("campaign_id = 'hot'"), F.unix_seconds("ingested_at")) == [(39999,)]


def test_unified_latest_keeps_platforms_apart(frame):
    g = google(
        frame,
        (DAY, "7", "G1", 1, 1, 1, 1.0, instant(1), "a"),
        (DAY, "7", "G2", 1, 1, 1, 1.0, instant(2), "b"),
    )
    m = meta(frame, (DAY, 7, "M", 1, 1, 1, 1.0, 0, 0, 0, instant(1), "a"))
    got = latest_unified(unified.unify(staging.stage_google(g), staging.stage_meta(m)))
    assert values(got, "platform", "campaign_name") == [("google_ads", "G2"), ("meta_ads", "M")]


def test_late_window_is_as_of_and_seven_days_before(frame):
    df = frame([(dt.date(2024, 1, d),) for d in range(1, 21)], "date date")
    got = [r[0].day for r in late_window(df, "2024-01-15").orderBy("date").collect()]
    assert got == list(range(8, 16))


def test_restatement_keeps_campaigns_missing_from_the_batch(frame):
    stored = google(
        frame,
        (DAY, "g1", "old", 1, 1, 1, 1.0, instant(1), "a"),
        (DAY, "g2", "kept", 1, 1, 1, 1.0, instant(1), "a"),
        (dt.date(2023, 12, 1), "g1", "too old", 1, 1, 1, 1.0, instant(1), "a"),
    )
    batch = google(frame, (DAY, "g1", "new", 1, 1, 1, 1.0, instant(2), "b"))
    got = restate(stored, batch, "2024-01-06")
    assert values(got, "campaign_id", "campaign_name") == [("g1", "new"), ("g2", "kept")]


def test_typed_staging(frame):
    text = frame([("2024-01-05", "c", "12"), ("2024-01-05", "c", None)],
                 "date string, campaign_id string, clicks string")
    got = staging.typed(text, S.GOOGLE_RECORD)
    assert values(got) == [(DAY, "c", 12), (DAY, "c", None)]
    bad = frame([("soon", "c", "x")], "date string, campaign_id string, clicks string")
    assert values(staging.typed(bad, S.GOOGLE_RECORD, lenient=True)) == [(None, "c", None)]


def test_quality_flag(frame):
    df = frame([(1, 2), (2, 2), (None, 1)], "impressions long, clicks long")
    got = [r["is_invalid_clicks"] for r in staging.with_quality_flags(df).collect()]
    assert got == [True, False, False]


def test_key_filters_and_columns_reach_the_scan(spark, frame, folder):
    g, m = sample(frame)
    gp, mp = folder("g"), folder("m")
    g.write.parquet(gp)
    m.write.parquet(mp)
    built = mart.mart_from_raw(spark.read.parquet(gp), spark.read.parquet(mp))
    plan = built.select("report_date", "ctr")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(date), IsNotNull(campaign_id)]") == 2
    assert plan.count("ReadSchema: struct<date:date,campaign_id:string,impressions:bigint,clicks:bigint>") == 1
    assert "Exchange" not in plan
    one_platform = built.where(F.col("platform") == S.META)
    assert one_platform._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_views_answer_sql(spark, frame):
    g, m = sample(frame)
    mart.register_views(spark, g, m)
    got = spark.sql(
        "select platform, sum(spend) as total_spend from mart_campaign_daily"
        " where report_date >= current_date() - 100000 group by platform"
    )
    assert values(got) == [("google_ads", 5.0), ("meta_ads", 8.0)]


def test_latest_per_key_over_other_columns(frame):
    df = frame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert values(latest_per_key(df, ["k"], ["v"])) == [("a", 2), ("b", 1)]
