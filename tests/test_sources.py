import json

import pytest
from pyspark.sql import functions as F

from adloom import schemas as S
from adloom import sources
from adloom.operators.metadata import stamp
from conftest import values


@pytest.fixture()
def landed(tmp_path):
    def write(records, as_array=False):
        text = json.dumps(records) if as_array else "\n".join(map(json.dumps, records))
        (tmp_path / "landed.json").write_text(text)
        return str(tmp_path)

    return write


def google_record(day, **changes):
    return {
        "date": day, "campaign_id": "c1", "campaign_name": "One", "impressions": 100,
        "clicks": 5, "conversions": 1, "cost_usd": 2.5, **changes,
    }


def test_range_includes_both_ends(spark, landed):
    path = landed([google_record(f"2024-01-0{d}") for d in range(1, 6)])
    got = sources.GOOGLE_FLAT.read(spark, path, "2024-01-02", "2024-01-04")
    assert [str(r["date"]) for r in got.orderBy("date").collect()] == [
        "2024-01-02", "2024-01-03", "2024-01-04",
    ]
    assert got.columns == S.GOOGLE_RECORD.names


def test_one_day_returns_that_day_only(spark, landed):
    path = landed([google_record("2024-01-01"), google_record("2024-01-02")])
    got = sources.GOOGLE_FLAT.read(spark, path, "2024-01-01", "2024-01-01")
    assert {str(r["date"]) for r in got.collect()} == {"2024-01-01"}


def test_a_malformed_number_stops_the_read(spark, landed):
    path = landed([google_record("2024-01-01", clicks="many")])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sources.GOOGLE_FLAT.read(spark, path, "2024-01-01", "2024-01-01").collect()


def test_fields_the_flat_payload_lacks_read_as_null(spark, landed):
    path = landed(
        [{"date": "2024-01-01", "campaign_id": 17, "campaign_name": "M", "impressions": 1,
          "clicks": 1, "conversions": 4, "spend_usd": 1.5, "likes": 2, "comments": 3, "shares": 4}]
    )
    row = sources.META_FLAT.read(spark, path, "2024-01-01", "2024-01-01").first()
    assert row["campaign_id"] == "17" and row["likes"] == 2
    assert row["video_views"] is None and row["page_engagement"] is None


def insight(**changes):
    return {"date_start": "2024-01-01", "campaign_id": "7", "campaign_name": "M", **changes}


@pytest.mark.parametrize(
    "actions, expected",
    [
        (None, (0, 0, 0, 0, 0)),
        ([], (0, 0, 0, 0, 0)),
        (
            [{"action_type": t, "value": v} for t, v in
             [("post_reaction", "1"), ("comment", "2"), ("post", "3"), ("video_view", "4"),
              ("page_engagement", "5"), ("link_click", "99")]],
            (1, 2, 3, 4, 5),
        ),
        (
            [{"action_type": "comment", "value": "2"}, {"action_type": "comment", "value": "9"}],
            (0, 9, 0, 0, 0),
        ),
    ],
)
def test_actions_become_columns(spark, landed, actions, expected):
    payload = insight(impressions="10", clicks="2", spend="1.25")
    if actions is not None:
        payload["actions"] = actions
    row = sources.META_NESTED.read(spark, landed([payload]), "2024-01-01", "2024-01-01").first()
    assert tuple(row[c] for c in S.ENGAGEMENT_ACTIONS) == expected
    assert (row["impressions"], row["clicks"], row["spend_usd"]) == (10, 2, 1.25)


def test_absent_measures_count_as_zero(spark, landed):
    row = sources.META_NESTED.read(spark, landed([insight()]), "2024-01-01", "2024-01-01").first()
    assert (row["impressions"], row["clicks"], row["spend_usd"]) == (0, 0, 0.0)


def test_array_files_with_account_naming(spark, landed):
    record = {"date": "2024-01-01", "account_id": "a", "campaign_id": "c", "campaign_name": "N",
              "impressions": 1000, "clicks": 50, "spend": 120.5, "conversions": 8}
    path = landed([record, {**record, "date": "2024-01-02"}], as_array=True)
    got = sources.GOOGLE_SAMPLE.read(spark, path, "2024-01-01", "2024-01-31")
    assert sorted(got.columns) == sorted(S.GOOGLE_RECORD.names) and got.count() == 2
    meta = sources.META_SAMPLE.read(spark, path, "2024-01-01", "2024-01-01").first()
    assert meta["spend_usd"] == 120.5


def test_a_platform_of_its_own_only_has_to_read(spark):
    class Fixed:
        name = "other_ads"

        def read(self, spark, path, start, end):
            return spark.range(3).select(F.col("id").alias("campaign_id"))

    source: sources.Source = Fixed()
    got = stamp(source.read(spark, "", "2024-01-01", "2024-01-01"), source.name, "r", "2024-01-01T00:00:00Z")
    assert values(got, "extract_run_id", "source") == [("r", "other_ads")] * 3


def test_day_folders_are_pruned(spark, folder):
    rows = spark.createDataFrame(
        [(f"2024-01-0{d}", "c", d) for d in range(1, 5)], "date string, campaign_id string, clicks int"
    )
    path = folder("pruning")
    rows.write.partitionBy("date").json(path)
    got = sources.GOOGLE_FLAT.read(spark, path, "2024-01-02", "2024-01-03")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert got.count() == 2


def test_stamp_gives_the_whole_batch_one_instant_and_run(spark):
    batch = stamp(spark.range(1000).repartition(4), S.GOOGLE)
    assert batch.select(*S.METADATA_COLUMNS).distinct().count() == 1
    assert len(batch.first()["extract_run_id"]) == 36
