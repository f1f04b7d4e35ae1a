"""Uniqueness of keys by digests that add up.

When days are written, two order-free digests of each are recorded: one of the keys of all its rows
and one of its distinct keys. They are equal exactly where no key repeats (but for a chance of
2^-128), so an audit of the whole table compares one recorded row for each day and reads no key. Only days
that differ are grouped, to name the keys. A digest is the sum and the exclusive or of two 64-bit
hashes of each key, both of which add up over tasks and days.

A NULL in a key is a value like any other. Rows without a day are a day like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom import schemas as S
from adloom.operators.quality import duplicate_grain

_SEEDS = ("", "second")


def _hashes(keys: Sequence[str]) -> list[Column]:
    # A NULL leaves a hash as it is; said in text it counts.
    told = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
    return [F.xxhash64(F.lit(seed), *told) for seed in _SEEDS]


def _digest(hashes: Sequence[Column]) -> Column:
    parts = []
    for i, h in enumerate(hashes):
        parts += [F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"sum{i}"), F.bit_xor(h).alias(f"xor{i}")]
    return F.struct(*parts)


def day_digests(rows: DataFrame, keys: Sequence[str] = S.GRAIN, day: str = "report_date") -> DataFrame:
    """day, n_rows, n_keys, of_rows, of_keys: the digests of every day of the rows.

    Rows are combined by key first, so a frequent key is one row for each task.
    """
    by_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    first, second = _hashes(keys)
    # Over all rows a key's hash counts as often as it occurs: n times in the sum, n mod 2 in the other.
    n, odd = F.col("_n"), F.col("_n") % 2 == 1
    of_rows = []
    for i, h in enumerate((first, second)):
        of_rows.append(F.sum(h.cast("decimal(20,0)") * n.cast("decimal(12,0)")).cast("decimal(38,0)").alias(f"sum{i}"))
        of_rows.append(F.coalesce(F.bit_xor(F.when(odd, h)), F.lit(0).cast("bigint")).alias(f"xor{i}"))
    return by_key.groupBy(F.col(day).alias("day")).agg(
        F.sum("_n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.struct(*of_rows).alias("of_rows"),
        _digest((first, second)).alias("of_keys"),
    )


def row_digests(rows: DataFrame, keys: Sequence[str] = S.GRAIN, day: str = "report_date") -> DataFrame:
    """day, n_rows, of_rows of stored rows, combined per task: no key is grouped or moved."""
    return rows.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), _digest(_hashes(keys)).alias("of_rows")
    )


def latest_digests(recorded: DataFrame) -> DataFrame:
    """Of days that were recorded several times (``recorded_at``), the last record."""
    last = Window.partitionBy("day").orderBy(F.desc("recorded_at"))
    return recorded.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "recorded_at")


def repeated_days(recorded: DataFrame) -> DataFrame:
    """Days on which some key repeats, from their records alone."""
    return recorded.where(~F.col("of_rows").eqNullSafe(F.col("of_keys"))).select("day")


def changed_days(recorded: DataFrame, rows: DataFrame, keys: Sequence[str] = S.GRAIN, day: str = "report_date") -> DataFrame:
    """Days whose stored rows aren't those that were recorded, by one scan of the key columns."""
    now = row_digests(rows, keys, day).select(F.col("day").alias("_day"), F.col("of_rows").alias("_now"))
    both = recorded.join(now, F.col("day").eqNullSafe(F.col("_day")), "full")
    changed = both.where(~F.col("of_rows").eqNullSafe(F.col("_now")))
    return changed.select(F.coalesce("day", "_day").alias("day"))


def duplicates_of_days(rows: DataFrame, days: DataFrame, keys: Sequence[str] = S.GRAIN, day: str = "report_date") -> DataFrame:
    """The repeated keys of some days; rows of other days are passed over before the grouping."""
    wanted = days.select(F.col("day").alias("_day"))
    among = rows.join(F.broadcast(wanted), F.col(day).eqNullSafe(F.col("_day")), "left_semi")
    return duplicate_grain(among, keys)
