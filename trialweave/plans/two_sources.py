"""A generic job over two delimited sources: clean, deduplicate, filter, join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.operators import aggregates, columns, joins
from trialweave.operators.filters import positive_and_known


@dataclass(frozen=True)
class Source:
    """One source and how to clean it; ``order`` decides which duplicate is the first."""

    df: DataFrame
    key: str
    order: Sequence[Column]
    positive: str
    known: str
    drop: Sequence[str] = field(default_factory=tuple)

    def cleaned(self) -> DataFrame:
        first = aggregates.dedup_keep_first(
            columns.drop_columns(self.df, self.drop), [self.key], self.order
        )
        return first.where(positive_and_known(F.col(self.positive), F.col(self.known)))


def join_two_sources(left: Source, right: Source) -> DataFrame:
    return joins.join_on_pairs(left.cleaned(), right.cleaned(), {left.key: right.key})
