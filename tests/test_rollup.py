import datetime as dt
import random

import pytest
from adloom import schemas as S
from adloom.operators import calendar, rollup
from adloom.plans import analysis
from conftest import values
from pyspark.sql import functions as F

AS_OF = "2024-01-25"


@pytest.fixture()
def mart(frame):
    chosen = random.Random(7)
    rows = []
    for d in range(1, 26):
        for c in range(30):
            if chosen.random() < 0.6:
                maybe = lambda v: v if chosen.random() < 0.8 else None
                rows.append((
                    dt.date(2024, 1, d), None if c == 29 else f"c{c}", f"Campaign {c % 20}", S.PLATFORMS[c % 2],
                    chosen.randint(0, 500), maybe(round(chosen.random() * 900, 2)), maybe(chosen.randint(0, 9)),
                    maybe(round(chosen.random(), 4)), maybe(round(chosen.random() * 30, 2)), maybe(round(chosen.random() * 3, 4)),
                ))
    return frame(
        rows,
        "report_date date, campaign_id string, campaign_name string, platform string, impressions long,"
        " spend double, conversions long, ctr double, cpa double, roas double",
    ).repartition(5)


@pytest.fixture()
def stored(spark, folder):
    def store(df):
        at = folder("state")
        df.write.parquet(at)
        return spark.read.parquet(at)

    return store


@pytest.mark.parametrize("days", [0, 6, 40])
def test_platforms_from_states_as_from_the_mart(mart, stored, days):
    numbers = stored(rollup.number_campaigns(mart))
    states, bitmaps = stored(rollup.daily_states(mart)), stored(rollup.daily_bitmaps(mart, numbers))
    window, distinct = rollup.window_state(states, AS_OF, days), rollup.distinct_campaigns(bitmaps, AS_OF, days)
    got = rollup.platform_comparison(window, distinct)
    assert values(got) == values(analysis.platform_comparison(mart, AS_OF, days).select(*got.columns))
    raw = rollup.platform_comparison(window, distinct, rounded=False)
    assert values(raw) == values(analysis.platform_comparison_raw(mart, AS_OF, days).select(*raw.columns))


def test_a_window_moves_day_by_day(mart, stored):
    """Adding and taking away days leaves exactly the sum of the days that remain."""
    by = rollup.CAMPAIGN
    states = stored(rollup.daily_states(mart, by))
    window = stored(rollup.window_state(states.where("report_date <= date'2024-01-10'"), "2024-01-10", 5, by))
    for d in range(11, 26):
        as_of = dt.date(2024, 1, d)
        window = stored(rollup.advance(window, states, as_of, 5, by))
        fresh = rollup.window_state(states.where(F.col("report_date") <= F.lit(as_of)), as_of, 5, by)
        if d in (11, 16, 25):
            assert values(window, *by, *rollup.PARTS) == values(fresh, *by, *rollup.PARTS)
    assert values(rollup.top_roas(window)) == values(analysis.top_roas(mart, AS_OF, 5))
    assert values(rollup.top_spend(window)) == values(analysis.top_spend(mart, AS_OF, 5))


def test_numbers_stay_and_new_campaigns_follow(mart, stored):
    first = stored(rollup.number_campaigns(mart.where("report_date < date'2024-01-02'")))
    every = stored(rollup.number_campaigns(mart, first))
    assert set(values(first)) <= set(values(every))
    assert every.select("number").distinct().count() == every.count() == 29
    assert values(rollup.number_campaigns(mart, every)) == values(every)
    assert rollup.number_campaigns(mart.where("false"), first.where("false")).count() == 0


def test_runs_and_gaps_of_days(frame):
    day = lambda d: dt.date(2024, 1, d)
    rows = [(day(d), c) for c, ds in (("a", (1, 2, 3, 7, 8)), ("b", (2,)), ("c", range(1, 11)), (None, (4,))) for d in ds]
    raw = frame([*rows, rows[0], (None, "a")], "date date, campaign_id string")
    runs = calendar.day_runs(raw.where("campaign_id is not null"), ["campaign_id"])
    assert values(runs) == [
        ("a", day(1), day(3), 3), ("a", day(7), day(8), 2), ("b", day(2), day(2), 1), ("c", day(1), day(10), 10),
    ]
    gaps = calendar.missing_runs(raw, "2024-01-01", "2024-01-10")
    assert values(gaps) == [("a", day(4), day(6)), ("a", day(9), day(10)), ("b", day(1), day(1)), ("b", day(3), day(10))]
    assert values(calendar.unrolled(gaps)) == values(calendar.missing_campaign_days(raw, "2024-01-01", "2024-01-10"))


def test_ten_years_cost_as_many_rows_as_gaps(frame):
    raw = frame([(dt.date(2020, 6, 1), "a"), (dt.date(2024, 6, 1), "a")], "date date, campaign_id string")
    gaps = calendar.missing_runs(raw, "2015-01-01", "2024-12-31")
    assert gaps.count() == 3
    assert "sequence" not in gaps._jdf.queryExecution().optimizedPlan().toString()
    assert calendar.unrolled(gaps).count() == 3653 - 2
