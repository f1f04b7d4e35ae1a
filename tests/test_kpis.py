import random
from decimal import Decimal

import pytest

from adloom.functions import kpis
from adloom.functions.aggregates import exact_avg, exact_sum, exact_total
from pyspark.sql import functions as F

METRICS = "impressions long, clicks long, conversions long, spend double"


def computed(frame, *row):
    return frame([row], METRICS).select(*kpis.kpi_columns()).first()


def test_ordinary_row(frame):
    row = computed(frame, 1000, 50, 8, 120.50)
    assert tuple(row) == (0.05, 15.06, 0.0664, 2.41, 0.16)


@pytest.mark.parametrize("denominator", [0, None, -5])
def test_no_kpi_without_a_positive_denominator(frame, denominator):
    spend = None if denominator is None else float(denominator)
    row = computed(frame, denominator, denominator, denominator, spend)
    assert tuple(row) == (None,) * 5


def test_missing_conversions_leave_the_other_kpis(frame):
    row = computed(frame, 100, 10, None, 20.0)
    assert row["ctr"] == 0.1 and row["cpc"] == 2.0
    assert row["cpa"] is None and row["roas"] is None and row["conversion_rate"] is None


def test_ties_round_away_from_zero(frame):
    # 57 / 800 = 0.07125 exactly in decimal, slightly below it in binary
    assert computed(frame, 800, 57, 1, 1.0)["ctr"] == 0.0713
    assert computed(frame, 1, 8, 8, 1.0)["cpc"] == 0.13


def test_safe_divide_never_fails(frame):
    df = frame([(1, 0), (None, 2), (1, None), (1, 4)], "a long, b long")
    got = [r[0] for r in df.select(kpis.safe_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [None, None, None, 0.25]


def test_bands(frame):
    df = frame([(3.0,), (2.9999,), (2.0,), (1.0,), (0.99,), (None,)], "roas double")
    got = [r[0] for r in df.select(kpis.efficiency_band(F.col("roas"))).collect()]
    assert got == ["Excellent", "Bon", "Bon", "Acceptable", "À Améliorer", "À Améliorer"]


def test_target_flags_are_strict_and_unknown_stays_unknown(frame):
    df = frame(
        [(0.02, 5.0, 0.05), (0.0201, 4.99, 0.0501), (None, None, None)],
        "ctr double, cpa double, conversion_rate double",
    )
    got = [tuple(r) for r in df.select(*kpis.target_flags()).collect()]
    assert got == [(False, False, False), (True, True, True), (None, None, None)]


def test_exact_aggregates_do_not_depend_on_order(spark):
    rows = spark.range(0, 30000).select(
        (F.col("id") % 3).alias("g"), F.round(F.col("id") * 0.1, 2).alias("x")
    )
    first = rows.repartition(1).groupBy("g").agg(exact_sum("x").alias("s"), exact_avg("x").alias("m"))
    second = rows.orderBy(F.desc("id")).groupBy("g").agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("m")
    )
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_exact_average_skips_nulls(frame):
    df = frame([(1.0,), (None,), (2.0,)], "x double")
    assert df.agg(exact_avg("x")).first()[0] == 1.5
    assert df.where("x > 5").agg(exact_avg("x")).first()[0] is None


@pytest.mark.parametrize("values", [[0.1] * 10, [-0.25, 0.1], [1e9 + 0.35, 0.65], [4.35, 2.01, 0.29]])
def test_exact_total_is_the_decimal_sum(frame, values):
    df = frame([(v,) for v in values], "x double")
    assert df.agg(exact_total(F.col("x"))).first()[0] == sum(Decimal(str(v)) for v in values)


def test_exact_total_of_any_numbers_of_fifteen_digits(spark):
    """Magnitudes from 10^-12 to 10^15, both signs, in any order."""
    chosen = random.Random(11)
    rows = [(0, Decimal("1e-12")), (0, Decimal("-1e-12")), (1, Decimal("999999999999999")), (1, Decimal("-999.999999999999"))]
    for group in range(2, 30):
        for _ in range(80):
            number = chosen.choice((1, -1)) * chosen.randint(1, 10 ** chosen.randint(1, 15) - 1)
            rows.append((group, Decimal(number).scaleb(-chosen.randint(0, 12))))
    chosen.shuffle(rows)
    df = spark.createDataFrame([(g, float(d)) for g, d in rows], "g int, x double").repartition(5)
    got = dict(df.groupBy("g").agg(exact_total(F.col("x")).alias("total")).collect())
    for group in got:
        assert got[group] == sum(Decimal(str(float(d))) for g, d in rows if g == group)


def test_exact_total_rounds_longer_numbers_at_the_digits_a_double_carries(frame):
    df = frame([(1234567.123456789,), (0.1 + 0.2,), (1e-13,), (9e18,), (-9e18,)], "x double")
    assert df.agg(exact_total(F.col("x"))).first()[0] == Decimal("1234567.423456790000")
    with pytest.raises(Exception, match="OVERFLOW"):
        frame([(1e19,)], "x double").agg(exact_total(F.col("x"))).collect()


def test_values_that_are_not_numbers_stop_the_query(frame):
    with pytest.raises(Exception, match="OVERFLOW"):
        frame([(float("nan"),), (1.0,)], "x double").agg(exact_sum("x")).collect()


def test_decimal_spend_gives_the_same_kpis(frame):
    df = frame([(1000, 50, 8, Decimal("120.50"))], METRICS.replace("double", "decimal(18,2)"))
    assert tuple(df.select(*kpis.kpi_columns()).first()) == (0.05, 15.06, 0.0664, 2.41, 0.16)
    assert df.agg(exact_sum("spend")).first()[0] == 120.5
