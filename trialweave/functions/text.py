"""Free text: trimming, criteria and term lists, row-to-text rendering."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialweave.functions import lists
from trialweave.functions.values import SPACE_CLASS, bind, strip

__all__ = ["criteria", "has_word", "labelled_line", "normalise", "one_space", "strip", "terms"]

def normalise(c: Column) -> Column:
    """Collapse white space, trim, lower-case."""
    return F.lower(strip(one_space(c)))


def one_space(c: Column) -> Column:
    """Every run of white space to one blank."""
    return F.regexp_replace(c, f"(?U){SPACE_CLASS}+", " ")


def has_word(c: Column, phrase: str) -> Column:
    """Whole-phrase test: ``Phase I`` is not found in ``Phase II``."""
    # The plain test comes first: it is cheap and rules most texts out. (?U) lets \b
    # follow Unicode letters.
    return c.contains(phrase) & c.rlike(r"(?U)\b" + re.escape(phrase) + r"\b")


# The headings that open the two parts of a criteria text.
_CRITERIA = {
    "inclusion": rf"(?isU)Inclusion Criteria.*?:{SPACE_CLASS}*(.*?)(?=Exclusion Criteria|$)",
    "exclusion": rf"(?isU)Exclusion Criteria.*?:{SPACE_CLASS}*(.*)$",
}


# Line breaks, marks to delete, comparison signs, and where single criteria begin.
_LINE_BREAK = r"\r\n|\r|\n"
_MARKS = r"[*•\\]"
_COMPARISONS = r"≥|≤|>=|<="
_ITEM_START = rf"(?U);{SPACE_CLASS}*|\d+\.{SPACE_CLASS}+"


def criteria(c: Column, kind: str = "inclusion") -> Column:
    """List of single criteria under one heading of a free text.

    Null text gives null. Text without the heading, or with nothing below it, gives a
    list of one null, so "looked for and not found" stays apart from "no text".
    """
    if kind not in _CRITERIA:
        raise ValueError(f"kind must be one of {sorted(_CRITERIA)}")
    text = strip(c)
    body = F.regexp_extract(text, _CRITERIA[kind], 1)
    body = F.regexp_replace(strip(body), _LINE_BREAK, "; ")
    body = F.regexp_replace(body, _MARKS, "")
    body = F.regexp_replace(body, _COMPARISONS, " ")
    body = F.trim(F.regexp_replace(body, f"(?U){SPACE_CLASS}{{2,}}", " "), F.lit("; "))
    items = F.transform(F.split(body, _ITEM_START), strip)
    items = F.filter(items, lambda item: item != "")
    nothing = F.array(F.lit(None).cast("string"))
    return F.when(c.isNotNull(), bind(items, lambda found: F.when(F.size(found) > 0, found).otherwise(nothing)))


def terms(columns: Sequence[Column]) -> Column:
    """One clean, ordered, duplicate-free list from several term columns.

    Each column is text: a list literal, or items split on ``|``, else on ``,``. Pass
    arrays through :func:`trialweave.functions.lists.to_text` with ``" | "`` first.
    Null where nothing is left.
    """
    parts = F.flatten(F.array(*[_term_items(c) for c in columns]))
    cleaned = F.transform(parts, _clean_term)
    kept = F.array_distinct(F.filter(cleaned, lambda item: item != ""))
    return bind(kept, lambda found: F.when(F.size(found) > 0, found))


def _term_items(c: Column) -> Column:
    divided = (
        F.when(c.contains("|"), F.split(c, r"\|"))
        .when(c.contains(","), F.split(c, ","))
        .otherwise(F.array(c))
    )
    return F.coalesce(
        F.array_compact(lists.parse_literal(c)),
        F.when(c.isNotNull(), F.transform(divided, strip)),
        F.array().cast("array<string>"),
    )


def _clean_term(item: Column) -> Column:
    # The heading prefix and codes of the register's disease tree.
    text = F.replace(F.replace(item, F.lit("Diseases [C] - "), F.lit("")), F.lit("'"), F.lit(""))
    text = strip(F.regexp_replace(F.lower(text), r"\(.*\)", ""))
    text = strip(F.regexp_replace(text, r"\[[a-z]+\d+\]", ""))
    return F.replace(text, F.lit("neoplasms"), F.lit("neoplasm"))


def labelled_line(fields: Sequence[tuple[str, Column]], default: str = "N/D") -> Column:
    """``- id: 1, Title: x`` from (label, value) pairs, missing values spelled out."""
    parts = [
        F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit(default)))
        for label, value in fields
    ]
    return F.concat(F.lit("- "), F.concat_ws(", ", *parts))
