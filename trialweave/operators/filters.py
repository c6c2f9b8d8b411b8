"""Row predicates and their composition into faceted search.

Every predicate is false, not null, where the tested value is missing. Where the test is
one a scan can take over, that is said as "known and ...": a coalesce around it would
hide it from the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.functions import text as txt
from trialweave.functions.values import holds


def positive_and_known(positive: Column, known: Column) -> Column:
    return (positive > 0) & known.isNotNull()


def is_in(c: Column, values: Sequence) -> Column:
    return c.isNotNull() & c.isin(*values)


def is_in_ignoring_case(c: Column, values: Sequence[str]) -> Column:
    return c.isNotNull() & F.lower(c).isin(*[v.lower() for v in values])


def flag_choice(c: Column, choice: bool | None) -> Column | None:
    """Three-way choice: no predicate for ``None``, else the flag must equal it."""
    return None if choice is None else c.isNotNull() & (c == choice)


def contains(c: Column, part: str) -> Column:
    """Case-sensitive substring."""
    return c.isNotNull() & c.contains(part)


def matches(c: Column, term: str, literal: bool = False) -> Column:
    """Case-insensitive pattern; ``literal`` takes the term as plain text."""
    return c.isNotNull() & c.rlike("(?iu)" + (re.escape(term) if literal else term))


def any_item_equals(c: Column, terms: Sequence[str]) -> Column:
    """Array holds one of the terms, compared trimmed and lower-cased."""
    items = F.transform(c, lambda item: F.lower(txt.strip(item)))
    return holds(F.arrays_overlap(items, F.array(*[F.lit(t.strip().lower()) for t in terms])))


def any_item_contains(c: Column, term: str) -> Column:
    """Some array item holds the term, in any case."""
    return holds(F.exists(c, lambda item: F.lower(item).contains(term.lower())))


def cell_contains(c: Column, term: str, is_array: bool = False) -> Column:
    """The cell written as text holds the term, in any case."""
    shown = F.array_join(c, " ") if is_array else c.cast("string")
    return holds(F.lower(shown).contains(term.lower()))


def matches_or_missing(c: Column, pattern: str) -> Column:
    return c.rlike(pattern) | c.isNull()


def any_known(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns])


def above(c: Column, cutoff: float) -> Column:
    return c.isNotNull() & (c > cutoff)


def where_all(df: DataFrame, predicates: Iterable[Column | None]) -> DataFrame:
    """Rows that meet every predicate; absent ones (``None``) ask nothing."""
    asked = [p for p in predicates if p is not None]
    return df.where(reduce(lambda a, b: a & b, asked)) if asked else df


def when_present(df: DataFrame, name: str, predicate) -> Column | None:
    """``predicate(column)`` only where the frame has the column."""
    return predicate(F.col(name)) if name in df.columns else None
