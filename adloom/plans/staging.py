"""Raw to staging: rename, keep the listed columns, require the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom import schemas as S


def _stage(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = set(raw.columns)
    optional = {f.name: f.dataType for f in S.META_RECORD.fields}
    return raw.where(F.col("date").isNotNull() & F.col("campaign_id").isNotNull()).select(
        *(
            F.col("date").alias("report_date") if c == "report_date"
            else F.col(c) if c in present
            else F.lit(None).cast(optional[c]).alias(c)
            for c in columns
        )
    )


def stage_google(raw: DataFrame) -> DataFrame:
    return _stage(raw, S.STG_GOOGLE_COLUMNS)


def stage_meta(raw: DataFrame) -> DataFrame:
    """Conversions of this platform are not kept, whether or not raw holds them.

    A raw table without video views or page engagement reads them as NULL.
    """
    return _stage(raw, S.STG_META_COLUMNS)


def typed(records: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Cast records to a layer's types; ``lenient`` turns malformed text into NULL."""

    def cast(field: T.StructField):
        column = F.col(field.name)
        value = column.try_cast(field.dataType) if lenient else column.cast(field.dataType)
        return value.alias(field.name)

    known = {f.name: f for f in schema.fields}
    return records.select(*(cast(known[c]) if c in known else F.col(c) for c in records.columns))


def with_quality_flags(rows: DataFrame) -> DataFrame:
    """Flag rows with more clicks than impressions; an unknown comparison is not flagged."""
    suspicious = F.when(F.col("clicks") > F.col("impressions"), True).otherwise(False)
    return rows.withColumn("is_invalid_clicks", suspicious)
