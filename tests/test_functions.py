import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adloom.functions import conversion, days
from adloom.functions.aggregates import exact_sum
from adloom.functions.rounding import round_binary


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_between_days_is_inclusive(frame):
    df = frame([(dt.date(2024, 1, d),) for d in range(1, 6)], "date date")
    got = [r[0].day for r in df.where(days.between_days("date", "2024-01-02", "2024-01-04")).collect()]
    assert got == [2, 3, 4]


def test_a_day_filter_is_the_utc_day(frame):
    stamps = ["2024-01-29T23:59:59.999999Z", "2024-01-30T00:00:00Z", "2024-01-30T23:59:59Z", "2024-01-31T00:00:00Z"]
    df = frame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("t"))
    assert df.where(days.on_day("t", "2024-01-30")).count() == 2
    assert df.where(F.to_date("t") == "2024-01-30").count() == 2


def test_as_of_defaults_to_today(spark):
    assert one(spark, days.as_day(None)) == one(spark, F.current_date())


def test_elapsed_seconds_truncate(spark):
    start, end = days.as_instant("2024-01-01T00:00:00.5Z"), days.as_instant("2024-01-01T00:00:02.1Z")
    assert one(spark, days.elapsed_seconds(start, end)) == 1


def test_iso_text_round_trip(spark):
    text = "2024-01-30T05:06:07.123456+02:00"
    moment = days.as_instant(text)
    assert one(spark, days.iso_text(moment)) == "2024-01-30T03:06:07.123456Z"
    assert one(spark, days.as_instant(days.iso_text(moment)).cast("timestamp") == moment)


def test_numbers_with_defaults(frame):
    df = frame([("12",), (None,)], "x string")
    got = [r[0] for r in df.select(conversion.number_or(F.col("x"), "bigint", 0)).collect()]
    assert got == [12, 0]


def test_malformed_numbers_raise_unless_lenient(frame):
    df = frame([("a few",)], "x string")
    with pytest.raises(PySparkException):
        df.select(conversion.number_or(F.col("x"), "bigint", 0)).collect()
    assert df.select(conversion.number_or(F.col("x"), "bigint", 0, lenient=True)).first()[0] == 0


def test_present_only_keeps_order(spark):
    array = conversion.present_only(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))
    assert one(spark, array) == ["a", "b"]


def test_sizes_and_millis(spark):
    assert one(spark, conversion.to_megabytes(F.lit(1572864))) == 1.5
    assert one(spark, days.iso_text(conversion.from_millis(F.lit(1000)))) == "1970-01-01T00:00:01.000000Z"


def test_binary_rounding_is_that_of_the_double(spark):
    """Ties of the decimal text that are none of the double, and true ties, which go to even."""
    rng = random.Random(5)
    values = [0.125, 0.375, 2.675, 0.005, 0.015, 1.005, 8.025, 132.35, 0.0049999, 1e-9, 0.0, 0.25, 1e9 + 0.125]
    values += [abs(rng.randint(0, 9000) - n) / n * 100 for n in (rng.randint(1, 9000) for _ in range(5000))]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rows = frame.select("v", round_binary(F.col("v"), 2), round_binary(F.col("v"), 1)).collect()
    assert all(two == round(v, 2) and f"{one:.1f}" == f"{v:.1f}" for v, two, one in rows)


def test_sums_keep_small_amounts(spark):
    frame = spark.range(1_000_000).select(F.lit(0.0000004).alias("v"))
    assert frame.agg(exact_sum("v")).first()[0] == 0.4
    frame = spark.createDataFrame([(0.1,), (0.2,), (-0.3,), (1e15,), (None,)], "v double")
    assert frame.agg(exact_sum("v")).first()[0] == 1e15
