"""Scans of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_path(target: str) -> bool:
    return "/" in target


def scan(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by name, or Parquet files by path.

    Give the schema of files to keep the types of their folder columns from
    being derived from the folder names.
    """
    if not is_path(target):
        return spark.table(target)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(target)


def scan_as(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """A stored table in a fixed shape: listed columns, order and types.

    Columns added to the schema later read as NULL from older files.
    """
    if is_path(target):
        return spark.read.schema(schema).parquet(target).select(*schema.names)
    table = spark.table(target)
    present = set(table.columns)
    return table.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
