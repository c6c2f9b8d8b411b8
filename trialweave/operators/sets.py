"""Stacking frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.operators.columns import quoted


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns united, gaps null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_sources(sources: Mapping[str, DataFrame], label: str = "source", dates: Sequence[str] = (),
                  to_date=None) -> DataFrame:
    """Stack named sources with their name as a column.

    A column with unlike types becomes text in all sources, so no value is lost.
    Columns in ``dates`` are read with ``to_date`` and become null where they are no date.
    """
    kinds: dict[str, set[str]] = {}
    for df in sources.values():
        for name, kind in df.dtypes:
            kinds.setdefault(name, set()).add(kind)
    unlike = {name for name, found in kinds.items() if len(found) > 1 and name not in dates}

    def prepared(name: str, df: DataFrame) -> DataFrame:
        def column(c: str) -> Column:
            if c in dates:
                value = quoted(c)
                kind = df.schema[c].dataType
                is_text = isinstance(kind, T.StringType)
                return (to_date(value) if is_text and to_date else value.try_cast("date")).alias(c)
            return (quoted(c).cast("string") if c in unlike else quoted(c)).alias(c)

        return df.select(*[column(c) for c in df.columns], F.lit(name).alias(label))

    return union_by_name(*[prepared(name, df) for name, df in sources.items()])
