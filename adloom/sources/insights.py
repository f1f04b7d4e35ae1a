"""Daily-insight sources over landed files.

A source turns landed files into campaign-day records for an inclusive range of
days. Schemas are explicit: nothing is inferred, no file is read twice. Where
the landing folder is laid out as ``date=YYYY-MM-DD/`` the range prunes
folders; otherwise it is a filter pushed into the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom import schemas as S
from adloom.functions.conversion import action_count, number_or
from adloom.functions.days import Day, between_days


class Source(Protocol):
    """What a new platform has to provide; metadata, writes and dedup are shared."""

    name: str

    def read(self, spark: SparkSession, path: str, start: Day, end: Day) -> DataFrame:
        """Records between two days, both included."""


def flatten_insights(payload: DataFrame, lenient: bool = False) -> DataFrame:
    """Nested insight rows as flat records, one column per engagement action.

    Absent measures count as zero, also where the whole ``actions`` list is
    missing; of several entries with one action type the last one counts.
    """
    return payload.select(
        F.col("date_start").cast("date").alias("date"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        "campaign_name",
        number_or(F.col("impressions"), "bigint", 0, lenient).alias("impressions"),
        number_or(F.col("clicks"), "bigint", 0, lenient).alias("clicks"),
        number_or(F.col("spend"), "double", 0.0, lenient).alias("spend_usd"),
        *(
            action_count(F.col("actions"), action_type, lenient).alias(column)
            for column, action_type in S.ENGAGEMENT_ACTIONS.items()
        ),
    )


def rename_spend(spend_column: str) -> Callable[[DataFrame], DataFrame]:
    """Account-level records name their cost ``spend``; records name it per source."""

    def apply(records: DataFrame) -> DataFrame:
        return records.drop("account_id").withColumnRenamed("spend", spend_column)

    return apply


def _as_is(records: DataFrame) -> DataFrame:
    return records


@dataclass(frozen=True)
class LandedSource:
    """Files of one shape under one folder."""

    name: str
    schema: T.StructType
    day_column: str = "date"
    to_records: Callable[[DataFrame], DataFrame] = _as_is
    file_format: str = "json"
    # A malformed value stops the read; "PERMISSIVE" reads it as NULL instead.
    options: dict[str, str] = field(default_factory=lambda: {"mode": "FAILFAST"})

    def read(self, spark: SparkSession, path: str, start: Day, end: Day) -> DataFrame:
        landed = (
            spark.read.format(self.file_format)
            .schema(self.schema)
            .options(**self.options)
            .load(path)
            .where(between_days(self.day_column, start, end))
        )
        return self.to_records(landed)

    def stream(self, spark: SparkSession, path: str, **options: str) -> DataFrame:
        """The same records as an unbounded table of newly landed files."""
        landed = (
            spark.readStream.format(self.file_format)
            .schema(self.schema)
            .options(**self.options, **options)
            .load(path)
        )
        return self.to_records(landed)


_ARRAY_FILE = {"mode": "FAILFAST", "multiLine": "true"}

GOOGLE_FLAT = LandedSource(S.GOOGLE, S.GOOGLE_RECORD)
META_FLAT = LandedSource(S.META, S.META_RECORD)
META_NESTED = LandedSource(S.META, S.META_INSIGHT, "date_start", flatten_insights)
GOOGLE_SAMPLE = LandedSource(
    S.GOOGLE, S.ACCOUNT_RECORD, to_records=rename_spend("cost_usd"), options=_ARRAY_FILE
)
META_SAMPLE = LandedSource(
    S.META, S.ACCOUNT_RECORD, to_records=rename_spend("spend_usd"), options=_ARRAY_FILE
)
