"""Namespaces and table inventory."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions.conversion import to_megabytes
from adloom.operators.calendar import missing_keys
from adloom.operators.ledger import Ledger

# Layer -> schema name. A deployment passes its own mapping where these are taken.
LAYERS = {
    "raw": "ads_raw",
    "staging": "ads_staging",
    "intermediate": "ads_intermediate",
    "marts": "ads_marts",
}
DEFAULT_SCHEMA = LAYERS["staging"]


def schema_name(custom: str | None = None, default: str = DEFAULT_SCHEMA) -> str:
    """A custom name is taken as given, without a prefix; else the default applies."""
    return default if custom is None else custom.strip()


def qualified(table: str, layer: str, layers: Mapping[str, str] = LAYERS) -> str:
    return f"{schema_name(layers.get(layer))}.{table}"


def create_namespaces(
    spark: SparkSession, layers: Mapping[str, str] = LAYERS, location: str | None = None
) -> None:
    """Create each missing schema, below ``location`` if the warehouse default is not wanted."""
    for name in layers.values():
        at = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{at}")


def missing_namespaces(spark: SparkSession, layers: Mapping[str, str] = LAYERS) -> DataFrame:
    """Required schemas that the catalog does not hold."""
    required = spark.createDataFrame([(n,) for n in layers.values()], "namespace string")
    return missing_keys(required, spark.sql("SHOW SCHEMAS"), ["namespace"])


def file_inventory(name: str, rows: DataFrame) -> DataFrame:
    """Row count and size of a stored table.

    Only file metadata is projected. Rows are counted per file, in part before
    the shuffle, so what moves grows with the number of files.
    """
    files = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("bytes")
    )
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        to_megabytes(F.coalesce(F.sum("bytes"), F.lit(0))).alias("size_mb"),
    ).select(
        F.lit(name).alias("table_name"),
        "row_count",
        "size_mb",
        (F.col("row_count") == 0).alias("is_empty"),
    )


def _created_at(spark: SparkSession, table: str) -> str | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0]
    return json.loads(described).get("created_time")


def location_of(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0]
    return json.loads(described)["location"]


def stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, bytes, modified_at of the Parquet files below a folder, as the file system lists them.

    No file is opened: only its listing is read.
    """
    listed = spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup="true")
    return listed.load(folder).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at")
    )


def inventory_by_day(spark: SparkSession, folder: str, ledger: Ledger, name: str, day: str = "date") -> DataFrame:
    """day, row_count, n_files, bytes, modified_at of a table laid out by day.

    Rows come from the ledger that the writes keep, files from the listing; no row is read.
    """
    value = F.regexp_extract("path", f"/{day}=([^/]*)/", 1)
    files = stored_files(spark, folder).select(F.try_to_date(value).alias("day"), "bytes", "modified_at")
    per_day = files.groupBy("day").agg(
        F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"), F.max("modified_at").alias("modified_at")
    )
    rows = ledger.counts().where(F.col("table_name") == name)
    counted = rows.groupBy(F.col("day").alias("of_day")).agg(F.sum("row_count").alias("row_count"))
    joined = per_day.join(counted, per_day.day.eqNullSafe(counted.of_day), "full")
    return joined.select(
        F.coalesce("day", "of_day").alias("day"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("row_count", "n_files", "bytes")),
        "modified_at",
    )


def table_inventory(spark: SparkSession, schema: str, names: Iterable[str] | None = None) -> DataFrame:
    """Tables of a schema with creation time, rows and size, newest first.

    Sizes are those of the file listing, rows a count without columns, which file footers answer.
    """
    if names is None:
        names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]

    def entry(name: str) -> DataFrame:
        table = f"{schema}.{name}"
        created = F.lit(_created_at(spark, table)).cast("timestamp").alias("created_at")
        size = stored_files(spark, location_of(spark, table)).agg(
            to_megabytes(F.coalesce(F.sum("bytes"), F.lit(0))).alias("size_mb")
        )
        rows = spark.table(table).agg(F.count(F.lit(1)).alias("row_count"))
        return rows.join(size).select(
            F.lit(name).alias("table_name"), created, "row_count", "size_mb", (F.col("row_count") == 0).alias("is_empty")
        )

    entries = [entry(name) for name in names]
    if not entries:
        return spark.createDataFrame(
            [],
            "table_name string, created_at timestamp, row_count bigint,"
            " size_mb double, is_empty boolean",
        )
    return reduce(DataFrame.unionByName, entries).orderBy(F.desc("created_at"), "table_name")
