"""A ledger of rows by table, day and ingestion day, kept by the writers.

The volume checks ask how many rows of each table were ingested on a day. The tables are laid out
by their own day, so answering from them means reading all of them. Here every write also
notes what it wrote: the counts are observed while the rows are written, without another pass,
and appended to the ledger as deltas. A write that replaces days first takes back what the ledger
holds for these days, a rebuilt table all of its entries, so after any of them the sums are those of
the stored rows, whatever was noted before. A crash between a write and its note leaves the
ledger behind; ``audit`` shows it, and ``settle`` (or the next write of these days) mends it.

Entries are one row for each pair of day and ingestion day that a write touched: their number
follows the days, not the rows. A day that is NULL is an entry like any other.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.days import Day, as_day, day_before
from adloom.sources.tables import is_path, scan

LEDGER = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("ingestion_day", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)
KEY = ("table_name", "day", "ingestion_day")

#: A histogram of up to so many different values counts each of them exactly.
PAIRS = 100_000
_EPOCH = dt.date(1970, 1, 1)
#: Days are numbered from here on, so that all dates are positive; 0 is NULL.
_FIRST, _SPAN = 1 << 20, 1 << 22

Count = tuple[dt.date | None, dt.date | None, int]


def _number(day: Column) -> Column:
    return F.coalesce(F.datediff(day, F.lit(_EPOCH)) + _FIRST, F.lit(0)).cast("bigint")


def _day(number: int) -> dt.date | None:
    return _EPOCH + dt.timedelta(number - _FIRST) if number else None


@dataclass(frozen=True)
class Watch:
    """What a writer notes about one stored table: the entries that its rows count for.

    ``tables`` maps names to the condition on the rows that belong to them; a view over the
    table may be among them. ``day`` is the column the table is laid out by.
    """

    ledger: Ledger
    tables: Mapping[str, Column | None]
    day: str = "date"

    def metrics(self) -> list[Column]:
        """Aggregates to observe while rows are written."""
        pair = _number(F.col(self.day)) * _SPAN + _number(F.to_date("ingested_at"))

        def counted(condition: Column | None) -> Column:
            value = pair if condition is None else F.when(condition, pair)
            bars = F.histogram_numeric(value.cast("double"), F.lit(PAIRS))
            return F.to_json(F.transform(bars, lambda b: F.array(b["x"].cast("bigint"), b["y"].cast("bigint"))))

        return [counted(c).alias(f"pairs{i}") for i, c in enumerate(self.tables.values())]

    def note(self, observed: Mapping[str, Any], target: str, replaced: str | None = None) -> None:
        """Enter what a write observed; ``replaced`` is "days" (those it wrote) or "all"."""
        found: dict[str, list[Count]] = {}
        for i, name in enumerate(self.tables):
            bars = json.loads(observed[f"pairs{i}"] or "[]")
            if len(bars) >= PAIRS:  # perhaps no longer exact
                self.ledger.settle(self, scan(self.ledger.spark, target))
                return
            sums: dict[int, int] = {}
            for pair, rows in bars:
                sums[pair] = sums.get(pair, 0) + rows
            found[name] = [(_day(pair // _SPAN), _day(pair % _SPAN), n) for pair, n in sums.items()]
        days = None
        if replaced == "days":
            days = {day for counts in found.values() for day, _, _ in counts}
        self.ledger.enter(found, take_back=replaced is not None, of_days=days)


@dataclass
class Ledger:
    """Deltas of row counts in a catalog table or folder."""

    spark: SparkSession
    target: str
    written_at: dt.datetime | None = field(default=None)

    def exists(self) -> bool:
        if not is_path(self.target):
            return self.spark.catalog.tableExists(self.target)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.target)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def entries(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], LEDGER)
        return scan(self.spark, self.target, LEDGER)

    def counts(self) -> DataFrame:
        """table_name, day, ingestion_day, row_count: what each table holds now."""
        sums = self.entries().groupBy(*KEY).agg(F.sum("row_count").alias("row_count"))
        return sums.where("row_count <> 0")

    def enter(
        self, counts: Mapping[str, Iterable[Count]], take_back: bool = False, of_days: set | None = None
    ) -> None:
        """Append counts; ``take_back`` first takes back what is there, of all days or of some."""
        now = self.written_at or dt.datetime.now(dt.timezone.utc)
        deltas = {(name, day, at): n for name, found in counts.items() for day, at, n in found}
        if take_back:
            held = self.counts().where(F.col("table_name").isin(*counts))
            if of_days is not None:
                known = F.col("day").isin(*(d for d in of_days if d is not None))
                held = held.where(known | F.col("day").isNull() if None in of_days else known)
            for row in held.collect():
                key = (row.table_name, row.day, row.ingestion_day)
                deltas[key] = deltas.get(key, 0) - row.row_count
        rows = [(*key, n, now) for key, n in deltas.items() if n]
        if not rows and self.exists():
            return
        written = self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.format("parquet").mode("append")
        if is_path(self.target):
            written.save(self.target)
        else:
            written.saveAsTable(self.target)

    def settle(self, watch: Watch, stored: DataFrame) -> None:
        """Count a stored table anew and bring its entries to that."""
        counted = recounted({name: (stored, condition, watch.day) for name, condition in watch.tables.items()})
        counts: dict[str, list[Count]] = {name: [] for name in watch.tables}
        for row in counted.collect():
            counts[row.table_name].append((row.day, row.ingestion_day, row.row_count))
        self.enter(counts, take_back=True)

    def day_counts(self, tables: Sequence[str], as_of: Day = None) -> DataFrame:
        """Rows ingested on ``as_of`` and on the day before, one row for each table."""
        names = self.spark.createDataFrame([(t,) for t in tables], "table_name string")
        at = F.col("ingestion_day")

        def on(day: Column) -> Column:
            return F.coalesce(F.sum(F.when(at == day, F.col("row_count"))), F.lit(0))

        near = self.entries().where((at >= day_before(as_of)) & (at <= as_day(as_of)))
        return (
            names.join(near, "table_name", "left")
            .groupBy("table_name")
            .agg(
                on(as_day(as_of)).alias("today_count"),
                on(day_before(as_of)).alias("yesterday_count"),
                F.lit(None).cast("string").alias("error"),
            )
        )

    def daily(self) -> DataFrame:
        """table_name, day (of ingestion), row_count."""
        by_day = self.counts().groupBy("table_name", F.col("ingestion_day").alias("day"))
        return by_day.agg(F.sum("row_count").alias("row_count"))

    def audit(self, stored: Mapping[str, tuple[DataFrame, Column | None, str]]) -> DataFrame:
        """Entries beside a recount of the stored rows: ledger_rows, stored_rows, differ.

        ``stored`` maps a name to the table, the condition on its rows and its day column.
        """
        left = self.counts().where(F.col("table_name").isin(*stored)).withColumnRenamed("row_count", "ledger_rows")
        right = recounted(stored).withColumnRenamed("row_count", "stored_rows")
        same = reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in KEY))
        sides = [F.coalesce(left[c], right[c]).alias(c) for c in KEY]
        both = left.join(right, same, "full").select(
            *sides, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("ledger_rows", "stored_rows"))
        )
        return both.withColumn("differ", F.col("ledger_rows") != F.col("stored_rows"))


def recounted(stored: Mapping[str, tuple[DataFrame, Column | None, str]]) -> DataFrame:
    """The counts of a ledger, from the rows themselves."""

    def of(name: str, rows: DataFrame, condition: Column | None, day: str) -> DataFrame:
        kept = rows if condition is None else rows.where(condition)
        return (
            kept.groupBy(F.col(day).alias("day"), F.to_date("ingested_at").alias("ingestion_day"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "day", "ingestion_day", "row_count")
        )

    return reduce(DataFrame.unionByName, (of(name, *table) for name, table in stored.items()))
