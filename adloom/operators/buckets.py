"""Raw tables bucketed by campaign within the day, so that versions of a campaign-day lie together.

All rows of a campaign are in the same bucket whatever run delivered them. The newest version of each
key of the late-data window is then found by one task for each bucket that reads its files of
these days side by side: no row moves, and what is written back is in the bucket it came from.
Buckets suit tables with many campaigns; a campaign's rows of one day are few.

NULL campaigns share a bucket. An empty batch creates the table and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.days import Day
from adloom.operators.latest import latest_raw, late_window
from adloom.operators.ledger import Watch
from adloom.operators.writes import _counted, _fitted, _overwrites_dynamically, _reported
from adloom.session import shared_folder

BUCKET_BY = "campaign_id"


def bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{table} isn't bucketed")
    return int(described["data_type"])


def append_bucketed(rows: DataFrame, table: str, buckets: int = 64, watch: Watch | None = None) -> int:
    """Append a batch to a table of so many buckets, creating it if absent; returns the rows written.

    One shuffle deals the batch to its buckets; each task then writes one file for each of its days.
    """
    spark = rows.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        buckets = bucket_count(spark, table)
        rows = _fitted(rows, table)
    counted, seen = _counted(rows.repartition(buckets, F.col(BUCKET_BY)), watch)
    writer = counted.write.format("parquet").mode("append")
    if exists:
        writer.insertInto(table)
    else:
        writer.partitionBy("date").bucketBy(buckets, BUCKET_BY).sortBy(BUCKET_BY).saveAsTable(table)
    return _reported(seen, table, watch)


def restated(spark: SparkSession, table: str, as_of: Day) -> DataFrame:
    """The newest version of each campaign-day of the late-data window, without a shuffle."""
    return latest_raw(late_window(spark.table(table), as_of), settle_ties=True)


def restate_bucketed(spark: SparkSession, table: str, as_of: Day, watch: Watch | None = None) -> int:
    """Replace the days of the late-data window by their newest rows; returns these rows.

    They are first written to a bucketed copy, which replaces the days by a second pass; neither
    moves a row between tasks. Until the copy is complete the table is unchanged, and the old
    days give way when the replacement commits.
    """
    buckets = bucket_count(spark, table)
    copy = f"{table}__restated"
    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    folder = shared_folder(spark, "restated")
    writer = restated(spark, table, as_of).write.format("parquet").option("path", folder).partitionBy("date")
    writer.bucketBy(buckets, BUCKET_BY).sortBy(BUCKET_BY).saveAsTable(copy)
    counted, seen = _counted(_fitted(spark.table(copy), table), watch)
    _overwrites_dynamically(spark, table)
    # A task reads the files of one bucket: it must go on writing that bucket.
    counted.write.insertInto(table, overwrite=True)
    spark.sql(f"DROP TABLE {copy}")
    return _reported(seen, table, watch, "days")
