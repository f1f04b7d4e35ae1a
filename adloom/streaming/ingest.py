"""Landed files to the raw zone, as they arrive.

The stream's checkpoint remembers which files were taken. A micro-batch is
written under a run id made from its number and replaces whatever that run wrote
before, so a batch repeated after a failure leaves no duplicates. Latest-wins
deduplication happens where the raw zone is read: dropping duplicates inside the
stream would keep the first version of a row instead of the newest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adloom.operators.ledger import Watch
from adloom.operators.metadata import stamp
from adloom.operators.writes import replace_run
from adloom.sources.insights import LandedSource

Clock = Callable[[int], "dt.datetime | str | None"]


def batch_run_id(stream_id: str, batch: int) -> str:
    return f"{stream_id}-{batch:010d}"


def write_batches(
    records: DataFrame,
    source: str,
    target: str,
    checkpoint: str,
    stream_id: str,
    ingested_at: Clock = lambda batch: None,
    watch: Watch | None = None,
) -> StreamingQuery:
    """Start a query that takes everything landed so far and then stops.

    ``ingested_at`` gives the instant of a batch from its number; by default it
    is the time the batch is processed.
    """

    def write(batch: DataFrame, number: int) -> None:
        run = batch_run_id(stream_id, number)
        replace_run(stamp(batch, source, run, ingested_at(number)), run, target, watch)

    return (
        records.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )


def ingest_landed(
    spark: SparkSession,
    source: LandedSource,
    landing: str,
    target: str,
    checkpoint: str,
    stream_id: str,
    files_per_batch: int = 1000,
    ingested_at: Clock = lambda batch: None,
    watch: Watch | None = None,
) -> None:
    """Ingest newly landed files of a source; a bounded number of files per batch."""
    records = source.stream(spark, landing, maxFilesPerTrigger=str(files_per_batch))
    query = write_batches(records, source.name, target, checkpoint, stream_id, ingested_at, watch)
    query.awaitTermination()
