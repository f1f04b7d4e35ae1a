"""Ingestion metadata."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.days import as_instant


def new_run_id() -> str:
    return str(uuid.uuid4())


def stamp(
    records: DataFrame,
    source: str,
    run_id: str | None = None,
    ingested_at: dt.datetime | str | None = None,
) -> DataFrame:
    """Tag a whole batch with one instant, one run id and its source.

    Both values are fixed on the driver: a per-row generator would give every
    row, and every retry of a task, a different one.
    """
    instant = ingested_at or dt.datetime.now(dt.timezone.utc)
    return records.withColumns(
        {
            "ingested_at": as_instant(instant),
            "extract_run_id": F.lit(run_id or new_run_id()),
            "source": F.lit(source),
        }
    )
