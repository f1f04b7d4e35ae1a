"""Union of the platforms in one schema."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom import schemas as S


@dataclass(frozen=True)
class Branch:
    """One platform: its staging frame, and where it names columns differently."""

    platform: str
    staging: DataFrame
    renamed: dict[str, str] = field(default_factory=dict)
    not_provided: frozenset[str] = frozenset()

    def to_unified(self) -> DataFrame:
        """Columns the platform does not provide are typed NULLs."""
        present = set(self.staging.columns) - self.not_provided

        def column(f):
            if f.name == "platform":
                return F.lit(self.platform).alias(f.name)
            name = self.renamed.get(f.name, f.name)
            value = F.col(name) if name in present else F.lit(None)
            return value.cast(f.dataType).alias(f.name)

        return self.staging.select(*(column(f) for f in S.UNIFIED.fields))


def unify_branches(branches: Iterable[Branch]) -> DataFrame:
    return reduce(DataFrame.unionByName, (b.to_unified() for b in branches))


def unify(stg_google: DataFrame, stg_meta: DataFrame) -> DataFrame:
    return unify_branches(
        (
            Branch(S.GOOGLE, stg_google, {"spend": "cost_usd"}),
            Branch(S.META, stg_meta, {"spend": "spend_usd"}, frozenset({"conversions"})),
        )
    )
