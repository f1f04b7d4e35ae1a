import datetime as dt

from pyspark.sql import functions as F

from adloom.operators import calendar, profile
from conftest import values


def day(n):
    return dt.date(2024, 1, n)


def test_scaffold_covers_every_day_without_a_join(frame):
    got = calendar.scaffold(frame([("a",), ("b",)], "campaign_id string"), "2024-01-01", "2024-01-03")
    assert values(got) == [(c, day(d)) for c in "ab" for d in (1, 2, 3)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_gaps_of_each_campaign(spark, frame, folder):
    raw = frame(
        [("a", day(1)), ("a", day(1)), ("a", day(3)), ("b", day(2)), ("c", day(9))],
        "campaign_id string, date date",
    )
    path = folder("gaps")
    raw.write.parquet(path)
    got = calendar.missing_campaign_days(spark.read.parquet(path), "2024-01-01", "2024-01-03")
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert values(got) == [("a", day(2)), ("b", day(1)), ("b", day(3))]


def test_missing_keys(frame):
    required = frame([("a",), ("b",), ("c",)], "k string")
    present = frame([("a",), ("a",), ("x",)], "k string")
    assert values(calendar.missing_keys(required, present, ["k"])) == [("b",), ("c",)]


def test_profile_of_a_batch(frame):
    batch = frame([("a", day(2), 1.1), ("a", day(1), 2.2), ("b", day(3), None)],
                  "campaign_id string, date date, spend_usd double")
    got = profile.ingestion_profile(batch, "spend_usd")
    assert values(got) == [(3, day(1), day(3), 2, 3.3)]
    empty = profile.ingestion_profile(batch.where(F.lit(False)), "spend_usd").first()
    assert tuple(empty) == (0, None, None, 0, 0.0)


def test_gaps_of_a_dimension(spark, frame):
    raw = frame(
        [(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 3), "a"), (dt.date(2024, 1, 2), None)],
        "date date, campaign_id string",
    )
    campaigns = frame([("a",), ("b",), ("b",), (None,)], "campaign_id string")
    got = calendar.missing_from_dimension(campaigns, raw, "2024-01-01", "2024-01-03")
    assert [(c, d.day) for d, c in values(got, "date", "campaign_id")] == [("b", 1), ("a", 2), ("b", 2), ("b", 3)]
    assert "NULL" not in str(values(calendar.missing_campaign_days(raw, "2024-01-01", "2024-01-03")))
    assert values(calendar.missing_campaign_days(raw, "2024-01-01", "2024-01-03"), "campaign_id") == [("a",)]
