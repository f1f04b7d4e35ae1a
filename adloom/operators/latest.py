"""Keep the newest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom import schemas as S
from adloom.functions.days import Day, between_days, day_before


def latest_per_key(
    rows: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str] = ("ingested_at", "extract_run_id"),
    settle_ties: bool = False,
) -> DataFrame:
    """One row per key; NULL keys form groups of their own.

    Spark plans the ``= 1`` filter as a group limit before the shuffle, so a
    task sends at most one row per key: a key that holds a large part of all
    rows does not overload the task that receives it.

    Of rows equal in every ordering column (one run that delivered a key twice)
    any one may be kept. ``settle_ties`` decides by a hash of the row, so that
    repeated runs agree; it needs every column, so use it where whole rows are
    written and leave it out where a query prunes columns.
    """
    order: list[Column] = [F.col(c).desc() for c in newest_first]
    if settle_ties:
        order.append(F.xxhash64(*(F.col(c) for c in rows.columns)).desc())
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_position", position).where("_position = 1").drop("_position")


def latest_raw(raw: DataFrame, settle_ties: bool = False) -> DataFrame:
    return latest_per_key(raw, S.RAW_KEY, settle_ties=settle_ties)


def latest_unified(unified: DataFrame) -> DataFrame:
    """A run id has no order of its own, so the newest ingestion decides."""
    return latest_per_key(unified, S.GRAIN)


def late_window(rows: DataFrame, as_of: Day, day_column: str = "date") -> DataFrame:
    """The days a daily run reads again: ``as_of`` and the seven before it."""
    return rows.where(between_days(day_column, day_before(as_of, S.LATE_DATA_DAYS), as_of))


def restate(stored: DataFrame, batch: DataFrame, as_of: Day) -> DataFrame:
    """Stored and newly extracted rows of the late-data window, newest version each.

    The result holds whole days, campaigns missing from the batch included, so
    it may replace those days in the raw zone.
    """
    merged = late_window(stored, as_of).unionByName(
        late_window(batch, as_of), allowMissingColumns=True
    )
    return latest_raw(merged, settle_ties=True)
