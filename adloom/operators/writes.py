"""Writes of raw and mart tables.

A target is a catalog table name or, if it contains a slash, a folder of Parquet
files. Every write first asks for a rebalance on its layout columns: adaptive
execution then gathers small partitions and splits a day (or platform) that
holds a large part of the batch over several tasks and files.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom import schemas as S
from adloom.operators.latest import latest_raw
from adloom.operators.ledger import LEDGER, Ledger, Watch
from adloom.operators.quality import duplicate_grain
from adloom.session import shared_folder
from adloom.sources.tables import is_path, scan

logger = logging.getLogger(__name__)

RAW_LAYOUT = ("date",)
MART_LAYOUT = ("report_date",)
MART_CLUSTER = ("platform", "campaign_id")


def _counted(rows: DataFrame, watch: Watch | None = None) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second pass."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    more = watch.metrics() if watch else []
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *more), seen


def _laid_out(rows: DataFrame, layout: Sequence[str]) -> DataFrame:
    return rows.hint("rebalance", *(F.col(c) for c in layout))


def _prepared(
    rows: DataFrame,
    layout: Sequence[str],
    cluster_by: Sequence[str],
    rebalance: bool = True,
    watch: Watch | None = None,
) -> tuple[DataFrame, Observation]:
    """Rows as they should be written: gathered by layout, counted, sorted last.

    Counting happens in the stage that writes, where a task that is repeated
    counts once; the sort on top is the one the partitioned write asks for.
    """
    moved = _laid_out(rows, (*layout, *cluster_by[:1])) if rebalance else rows
    counted, seen = _counted(moved, watch)
    if cluster_by:
        counted = counted.sortWithinPartitions(*layout, *cluster_by)
    return counted, seen


def _fitted(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the shape of a stored table.

    A column the batch lacks is NULL; one the table lacks is added to it, and
    reads as NULL from the rows stored before.
    """
    spark = rows.sparkSession
    known = set(spark.table(table).columns)
    added = [f for f in rows.schema.fields if f.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    given = set(rows.columns)
    return rows.select(
        *(
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        )
    )


def _overwrites_dynamically(spark: SparkSession, table: str) -> None:
    """An insertion takes its overwrite mode from the table, whatever the session's is."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Storage Properties'")
    row = detail.first()
    if row is None or "partitionOverwriteMode=dynamic" not in row["data_type"]:
        spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, layout: Sequence[str] = RAW_LAYOUT
) -> None:
    """An empty table, unless there is one."""
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema)
        empty.write.format("parquet").partitionBy(*layout).saveAsTable(table)


def append_raw(
    rows: DataFrame, target: str, layout: Sequence[str] = RAW_LAYOUT, watch: Watch | None = None
) -> int:
    """Append a batch, creating the table if absent; returns the rows written.

    ``watch``, here and in the other writers, notes the counts in a ledger.

    An empty batch adds no rows; its table is created like any other. Batches of one
    source may differ in their columns. The input is computed once: rows are counted
    while they are written.
    """
    if not is_path(target) and rows.sparkSession.catalog.tableExists(target):
        rows = _fitted(rows, target)
    counted, seen = _prepared(rows, layout, (), watch=watch)
    writer = counted.write.format("parquet").mode("append").partitionBy(*layout)
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
    return _reported(seen, target, watch)


def _reported(
    seen: Observation, target: str, watch: Watch | None = None, replaced: str | None = None
) -> int:
    observed = seen.get
    n = observed["rows"]
    if watch and (n or replaced == "all"):
        watch.note(observed, target, replaced)
    if not n:
        logger.warning("no rows to write to %s", target)
    return n


def replace_partitions(
    rows: DataFrame,
    target: str,
    layout: Sequence[str] = RAW_LAYOUT,
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
    watch: Watch | None = None,
) -> int:
    """Replace the partitions that occur in the batch and leave all others alone.

    With the day as the layout a rerun replaces its days; give whole days, or the
    campaigns missing from the batch are lost. An empty batch replaces nothing. Reading
    the table being written is allowed: the old partitions give way when the job
    commits. ``rebalance=False`` is for rows that already lie as they should be written.
    """
    spark = rows.sparkSession
    stored = not is_path(target) and spark.catalog.tableExists(target)
    if stored:
        rows = _fitted(rows, target)
    counted, seen = _prepared(rows, layout, cluster_by, rebalance, watch)
    if is_path(target):
        (
            counted.write.format("parquet")
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*layout)
            .save(target)
        )
    elif stored:
        # Insertion goes by position, in the stored column order.
        _overwrites_dynamically(spark, target)
        counted.write.insertInto(target, overwrite=True)
    else:
        counted.write.format("parquet").partitionBy(*layout).saveAsTable(target)
    return _reported(seen, target, watch, "days")


def _exists(spark: SparkSession, target: str) -> bool:
    if not is_path(target):
        return spark.catalog.tableExists(target)
    path, files = _path(spark, target)
    return files.exists(path)


def replace_run(rows: DataFrame, run_id: str, target: str, watch: Watch | None = None) -> int:
    """Write the rows of one run in the place of what that run wrote to their days before.

    The layout is by day, as of every raw table: the days of the batch are read, the run's
    own rows left out, and the days replaced. So a repeated batch leaves no duplicates,
    and small batches don't pile up as small files. Returns the rows of these days.
    """
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        days = [row["date"] for row in rows.select("date").distinct().collect()]
        if days and _exists(spark, target):
            stored = scan(spark, target)
            others = _of_days(stored, days).where(~F.col("extract_run_id").eqNullSafe(run_id))
            rows = others.unionByName(rows, allowMissingColumns=True)
        return replace_partitions(rows, target, watch=watch)
    finally:
        rows.unpersist()


def _of_days(rows: DataFrame, days: Sequence) -> DataFrame:
    wanted = F.col("date").isin(*(d for d in days if d is not None))
    return rows.where(wanted | F.col("date").isNull() if None in days else wanted)


def compact_days(spark: SparkSession, target: str, among: Column | None = None) -> int:
    """Rewrite days, all or those of a condition on ``date``, to files of the usual size."""
    stored = scan(spark, target)
    return replace_partitions(stored if among is None else stored.where(among), target)


def days_with_repeats(raw: DataFrame) -> DataFrame:
    """Days on which some key occurs more than once, from the key columns alone."""
    return duplicate_grain(raw, S.RAW_KEY).select("date").distinct()


def dedup_days(
    spark: SparkSession,
    target: str,
    copy: str | None = None,
    schema: T.StructType | None = None,
    among: Column | None = None,
    watch: Watch | None = None,
) -> int:
    """Rewrite a raw table to one row per key, the newest; returns the rows now held.

    Only days that hold repeated keys are rewritten, so a second call finds
    nothing to do and a daily one touches the days that were extracted again.
    Where those are known, a condition on ``date`` as ``among`` keeps the search
    for repeats from scanning the others.
    The kept rows are first written to ``copy`` (by default in the shared
    folder) and replace the stored days from there: until that copy is complete
    the table is unchanged, and if the replacement is interrupted
    ``replace_partitions(scan(spark, copy), target)`` completes it. Returns the
    rows that the rewritten days now hold. A copy of its own making goes at the end.
    """
    stored = scan(spark, target, schema)
    searched = stored if among is None else stored.where(among)
    days = [row["date"] for row in days_with_repeats(searched).collect()]
    if not days:
        return 0
    kept = latest_raw(_of_days(stored, days), settle_ties=True)
    folder = copy or shared_folder(spark, "dedup")
    logger.info("rewriting %d days of %s by way of %s", len(days), target, folder)
    _laid_out(kept, RAW_LAYOUT).write.partitionBy(*RAW_LAYOUT).parquet(folder)
    held = replace_partitions(scan(spark, folder, stored.schema), target, rebalance=False, watch=watch)
    if copy is None:
        _delete(spark, folder)
    return held


ROWS = "adloom.rows"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table. The files of an external one stay, so its partitions do too."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    _repair(spark, new)


def _repair(spark: SparkSession, table: str) -> None:
    """Point the partitions of a managed table, whose folder moved, at that folder."""
    if _details(spark, table).get("Type") == "EXTERNAL":
        return
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table} DROP PARTITIONS")
        spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")


def _discard(spark: SparkSession, table: str) -> None:
    """Drop a table and, where it is external, its folder."""
    details = _details(spark, table)
    spark.sql(f"DROP TABLE {table}")
    if details.get("Type") == "EXTERNAL":
        _delete(spark, details["Location"])


def _is_complete(spark: SparkSession, table: str) -> bool:
    """Whether the table holds as many rows as were written to it."""
    properties = _details(spark, table).get("Table Properties", "")
    written = re.search(rf"{re.escape(ROWS)}=(\d+)", properties)
    return written is not None and spark.table(table).count() == int(written[1])


def recover_table(spark: SparkSession, table: str) -> None:
    """Finish or undo a swap that was interrupted.

    The old copy is dropped only once the new one is there and holds as many rows as
    were written. If it does not, both stay and an error names them.
    """
    previous = f"{table}__previous"
    if not spark.catalog.tableExists(previous):
        return
    if not spark.catalog.tableExists(table):
        _rename(spark, previous, table)
        return
    _repair(spark, previous)
    if not _is_complete(spark, table):
        raise RuntimeError(f"{table} isn't complete; its former rows are in {previous}")
    _discard(spark, previous)


def swap_in(
    rows: DataFrame,
    table: str,
    layout: Sequence[str],
    cluster_by: Sequence[str] = (),
    watch: Watch | None = None,
) -> int:
    """Replace a catalog table as a whole; returns its rows.

    The rows may be computed from the table itself. Each build goes to a new folder of
    an external table and is counted there; two renames, which move no file, then give
    it the name. The old rows stay until the new ones are in place: after a crash at any
    point ``recover_table`` (each swap begins with it) leaves the old or the new table.
    Between the renames the name is missing for a moment.
    """
    spark = rows.sparkSession
    recover_table(spark, table)
    following, previous = f"{table}__next", f"{table}__previous"
    if spark.catalog.tableExists(following):
        _discard(spark, following)
    schema, _, name = table.rpartition(".")
    root = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    counted, seen = _prepared(rows, layout, cluster_by, watch=watch)
    writer = counted.write.format("parquet").partitionBy(*layout)
    writer.option("path", f"{root}/{name}-{uuid.uuid4().hex}").saveAsTable(following)
    n = seen.get["rows"]
    spark.sql(f"ALTER TABLE {following} SET TBLPROPERTIES ('{ROWS}' = '{n}')")
    if not _is_complete(spark, following):
        raise RuntimeError(f"{following} doesn't hold the {n} rows written to it")
    existed = spark.catalog.tableExists(table)
    if existed:
        _rename(spark, table, previous)
    _rename(spark, following, table)
    if existed:
        _discard(spark, previous)
    # Later appends change the number of rows.
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('{ROWS}')")
    return _reported(seen, table, watch, "all")


def compact_ledger(ledger: Ledger) -> int:
    """Rewrite a ledger kept as a catalog table to one entry for each table, day and ingestion day."""
    sums = ledger.counts().withColumn("written_at", F.current_timestamp()).select(*LEDGER.names)
    return swap_in(sums.repartition(1), ledger.target, ())


def _renamed(files, old, new) -> None:
    """Rename a folder; a file system reports by its answer that it didn't."""
    if files.exists(new):
        # Most file systems would move the folder into the other one.
        raise RuntimeError(f"{new} is there already")
    if not files.rename(old, new):
        raise RuntimeError(f"{old} could not be renamed to {new}")


def _noted(spark: SparkSession, folder) -> int | None:
    """The number of rows written to a folder, as its note says."""
    note, files = _path(spark, f"{folder}.rows")
    if not files.exists(note):
        return None
    return int(spark.read.text(note.toString()).first()[0])


def _holds_its_rows(spark: SparkSession, folder) -> bool:
    _, files = _path(spark, folder.toString())
    if not files.exists(folder):
        return False
    written = _noted(spark, folder)
    try:
        return written is not None and spark.read.parquet(folder.toString()).count() == written
    except AnalysisException:  # no file with a schema, or folders within folders
        return False


def _forget(spark: SparkSession, folder) -> None:
    for path in (folder.toString(), f"{folder}.rows"):
        _delete(spark, path)


def recover_folder(spark: SparkSession, target: str) -> None:
    """Finish or undo the replacement of a folder that was interrupted.

    Where a rename copies file by file, a crash may leave half of a folder under either name. The
    former rows stay below ``__previous`` until the folder holds as many rows as were written
    to it; if it does not, it gives way to them.
    """
    path, files = _path(spark, target)
    previous, _ = _path(spark, f"{target}__previous")
    if not files.exists(previous):
        return
    if not _holds_its_rows(spark, path):
        former = _noted(spark, previous)
        if former is None and files.exists(path):
            raise RuntimeError(f"it isn't noted which of {target} and {previous} is complete")
        if former is not None and not _holds_its_rows(spark, previous):
            # The copy to __previous was cut short: what it comes from is still whole.
            if spark.read.parquet(target).count() != former:
                raise RuntimeError(f"neither {target} nor {previous} is complete")
        else:
            _forget(spark, path)
            _renamed(files, previous, path)
    _forget(spark, previous)


def write_mart(mart: DataFrame, target: str, watch: Watch | None = None) -> int:
    """Build the whole mart table anew; returns its rows.

    Rows of a day and platform lie side by side, sorted by campaign within a
    file, so that readers who filter on platform or campaign skip row groups by
    their minima and maxima. A dominant day-platform spreads over several files. A folder
    is written next to the old one and takes its place once complete; how many rows each
    should hold is noted beside it.
    """
    if not is_path(target):
        return swap_in(mart, target, MART_LAYOUT, MART_CLUSTER, watch)
    spark = mart.sparkSession
    recover_folder(spark, target)
    path, files = _path(spark, target)
    following, _ = _path(spark, f"{target}__next-{uuid.uuid4().hex}")
    previous, _ = _path(spark, f"{target}__previous")
    counted, seen = _prepared(mart, MART_LAYOUT, MART_CLUSTER, watch=watch)
    counted.write.partitionBy(*MART_LAYOUT).parquet(following.toString())

    def note(folder, n: int) -> None:
        spark.createDataFrame([(str(n),)], "n string").coalesce(1).write.mode("overwrite").text(f"{folder}.rows")

    n = seen.get["rows"]
    if files.exists(path):
        note(previous, spark.read.parquet(target).count())
        _renamed(files, path, previous)
    note(path, n)
    try:
        _renamed(files, following, path)
    except Exception:
        recover_folder(spark, target)
        raise
    if files.exists(previous):
        if not _holds_its_rows(spark, path):
            raise RuntimeError(f"{target} isn't complete; its former rows are in {previous}")
        _forget(spark, previous)
    # Later refreshes change the number of rows.
    _delete(spark, f"{target}.rows")
    return _reported(seen, target, watch, "all")


def refresh_mart(mart: DataFrame, target: str, watch: Watch | None = None) -> int:
    """Replace only the days that the given mart rows cover.

    With a mart built over the restated days this leaves the table as a full
    build would, at the cost of those days.
    """
    return replace_partitions(mart, target, MART_LAYOUT, MART_CLUSTER, watch=watch)


def append_run(summary: DataFrame, target: str) -> None:
    """Append a run summary to the log."""
    writer = summary.select(*S.RUN_SUMMARY.names).write.format("parquet").mode("append")
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
