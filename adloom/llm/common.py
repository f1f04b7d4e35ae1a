"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from adloom.session import shared_folder

#: What separates words: the six ASCII white-space characters. In Python, bytes.split() does the same.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, stored in the shared folder and read again: what follows no longer depends on
    how they were made, so a lost executor costs a re-read and several uses cost one run.
    The files go when the application ends.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark, purpose)
    rows.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(rows.schema).parquet(folder)


def map_arrow(
    rows: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Apply to each Arrow batch what ``make`` builds once for each task."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            yield apply(batch)

    return rows.mapInArrow(over, schema)


class Fold(Protocol):
    """What is known of a group while its rows go by; built with the group's key."""

    def add(self, *values: Any) -> None: ...

    def result(self) -> tuple: ...


def folded(
    rows: DataFrame,
    key: str,
    order: Sequence[Column],
    values: Sequence[str],
    start: Callable[[Any], Fold],
    schema: str,
) -> DataFrame:
    """One row for each key: its rows go through ``add`` in the given order, one after another.

    A group lies in one sorted partition (Spark's sort spills) and streams through its task, which
    holds one batch of rows and what the fold keeps, so a key may have any number of rows. A null
    key is a group like any other.
    """
    kind = pa_fields(rows.sparkSession, schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, now, done = None, None, []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, given in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)):
                if fold is None or keys[at] != now:
                    if fold is not None:
                        done.append(fold.result())
                    now = keys[at]
                    fold = start(now)
                fold.add(*given)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays(_columns(done, kind), schema=kind)
                done = []
        if fold is not None:
            done.append(fold.result())
        yield pa.RecordBatch.from_arrays(_columns(done, kind), schema=kind)

    sorted_ = rows.repartition(F.col(key)).sortWithinPartitions(F.asc_nulls_first(key), *order)
    return sorted_.select(key, *values).mapInArrow(over, schema)


def _columns(rows: list[tuple], kind: pa.Schema) -> list[pa.Array]:
    columns = zip(*rows, strict=True) if rows else ([] for _ in kind)
    return [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)]


def pa_fields(spark: SparkSession, schema: str) -> pa.Schema:
    return to_arrow_schema(spark.createDataFrame([], schema).schema)
