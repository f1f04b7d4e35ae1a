"""A stream into a table of changes, of which readers take the newest row of each key.

Each batch is reduced to the newest row of each of its keys and stored below its days under the
number of the batch. A batch that is repeated after a failure replaces its own files, and no day is
read or written again, so the bytes written follow the rows that arrive, however many batches a
day comes in. ``newest_rows`` reads the newest version of each key; ``compact_changes`` now and then
rewrites days that several batches wrote to these rows alone.

Of equal instants the greatest run id is the newest, and a hash of the row settles ties. NULL days
and keys are like any other. An empty batch writes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.latest import latest_raw
from adloom.operators.writes import _delete, _path, replace_partitions
from adloom.session import shared_folder
from adloom.sources.tables import scan

#: The column that tells the batches of a day apart; readers in a fixed shape don't see it.
BATCH = "batch"
LAYOUT = ("date", BATCH)

def ingest_newest(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Take all that a stream of raw rows has landed and store the newest row of each key of a batch.

    A batch writes its own files and reads none.
    """

    def write(batch: DataFrame, number: int) -> None:
        newest = latest_raw(batch, settle_ties=True).withColumn(BATCH, F.lit(f"{number:010d}"))
        replace_partitions(newest, target, LAYOUT)

    query = (
        rows.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def _stored(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    return scan(spark, target, T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())]))


def newest_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The newest row of each key of what ``ingest_newest`` stored."""
    return latest_raw(_stored(spark, target, schema).select(*schema.names), settle_ties=True)


def compact_changes(spark: SparkSession, target: str, schema: T.StructType, among: Column | None = None) -> int:
    """Rewrite days that several batches wrote to one set of files with their newest rows.

    The kept rows are stored under a batch of their own before the others go: a crash leaves rows
    twice, which readers pass over, and never none. Returns the days rewritten.
    """
    stored = _stored(spark, target, schema)
    wanted = stored if among is None else stored.where(among)
    batches = wanted.select("date", BATCH).distinct().groupBy("date").agg(F.collect_list(BATCH).alias("batches"))
    days = batches.where(F.size("batches") > 1).collect()
    if not days:
        return 0
    known = F.col("date").isin(*(d.date for d in days if d.date is not None))
    of_days = stored.where(known | F.col("date").isNull() if any(d.date is None for d in days) else known)
    copy = shared_folder(spark, "compacted")
    kept = latest_raw(of_days.drop(BATCH), settle_ties=True).withColumn(BATCH, F.lit(f"kept-{uuid.uuid4().hex}"))
    replace_partitions(kept, copy, LAYOUT)
    replace_partitions(scan(spark, copy, kept.schema), target, LAYOUT, rebalance=False)
    _delete(spark, copy)
    _, files = _path(spark, target)
    for day in days:
        name = day.date.isoformat() if day.date is not None else "__HIVE_DEFAULT_PARTITION__"
        for batch in day.batches:
            files.delete(_path(spark, f"{target}/date={name}/{BATCH}={batch}")[0], True)
    return len(days)
