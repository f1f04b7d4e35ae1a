"""Schemas from data: batches whose types differ load into one table.

Values are read as text and each column takes the least type of a chain that holds all of its
values: nothing < int < bigint < double < text. The least type of two batches is the greater one in the
chain, so types are folded per task and combined like any maximum, and a table's types only
rise. A whole number beyond 2^53 in a column of doubles would lose digits: such a column is text.

Each batch is stored under the version of the schema that was valid when it came, in types that only rise
later; a reader takes each version in its own types and widens them. There are at most four versions
for each column.

NULL and missing values have no type and fit any. A column of none but these is text once it's read.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The chain, least first.
LATTICE = ("void", "int", "bigint", "double", "string")
_EXACT = 1 << 53
_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _level(text: Column) -> Column:
    """The place in the chain of one value's least type."""
    whole = text.rlike(r"^[+-]?\d{1,19}$")
    return (
        F.when(text.isNull(), 0)
        .when(text.try_cast("int").isNotNull() & whole, 1)
        .when(text.try_cast("bigint").isNotNull() & whole, 2)
        .when(text.rlike(f"^{_NUMBER}$"), 3)
        .otherwise(4)
    )


def batch_types(rows: DataFrame) -> dict[str, str]:
    """The least type of each column of a batch of texts, from one pass that combines per task."""
    beyond = lambda c: F.max(F.abs(F.col(c).try_cast("decimal(19,0)")) > _EXACT)
    parts = [e for c in rows.columns for e in (F.max(_level(F.col(f"`{c}`"))), beyond(f"`{c}`"))]
    found = rows.agg(*(p.alias(f"_{i}") for i, p in enumerate(parts))).first()
    types = {}
    for i, column in enumerate(rows.columns):
        level, large = found[2 * i] or 0, bool(found[2 * i + 1])
        types[column] = LATTICE[4 if level == 3 and large else level]
    return types


def widened(known: dict[str, str], found: dict[str, str]) -> dict[str, str]:
    """The least types that hold both; columns keep their order, new ones follow.

    Whole numbers of more than 32 bits beside doubles make text: as doubles they might lose digits.
    """
    types = dict(known)
    for column, kind in found.items():
        here = types.get(column, "void")
        both = {here, kind}
        types[column] = "string" if both == {"bigint", "double"} else max(both, key=LATTICE.index)
    return types


def _schema_file(folder: str, version: int) -> str:
    return f"{folder}/_schemas/{version:06d}"


def versions(spark: SparkSession, folder: str) -> list[dict[str, str]]:
    """The recorded schemas of a table, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_schemas")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(path))
    return [json.loads(spark.read.text(f"{folder}/_schemas/{n}").first()[0]) for n in names]


def _columns(types: dict[str, str]) -> list[tuple[str, str]]:
    return [(c, "string" if t == "void" else t) for c, t in types.items()]


def append_widening(rows: DataFrame, folder: str) -> dict[str, str]:
    """Append a batch of text columns, widening the table's schema if it must; returns the schema."""
    spark = rows.sparkSession
    known = versions(spark, folder)
    types = widened(known[-1] if known else {}, batch_types(rows))
    version = len(known) - 1
    if not known or types != known[-1]:
        version += 1
        record = spark.createDataFrame([(json.dumps(types),)], "schema string")
        record.coalesce(1).write.text(_schema_file(folder, version))
    given = set(rows.columns)
    shaped = rows.select(
        *((F.col(f"`{c}`") if c in given else F.lit(None)).cast(t).alias(c) for c, t in _columns(types))
    )
    shaped.write.mode("append").parquet(f"{folder}/v={version:06d}")
    return types


def read_widened(spark: SparkSession, folder: str) -> DataFrame:
    """All batches of a table in its widest schema."""
    known = versions(spark, folder)
    last = _columns(known[-1])

    def of(version: int, types: dict[str, str]) -> DataFrame:
        ddl = ", ".join(f"`{c}` {t}" for c, t in _columns(types))
        stored = spark.read.schema(ddl).parquet(f"{folder}/v={version:06d}")
        return stored.select(
            *((F.col(f"`{c}`") if c in types else F.lit(None)).cast(t).alias(c) for c, t in last)
        )

    return reduce(DataFrame.unionByName, (of(i, types) for i, types in enumerate(known)))
