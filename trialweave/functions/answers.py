"""Scored answers: a JSON list of rows inside a fenced block of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "```"
ANSWER_ROWS = "array<struct<database_index:bigint,certainty:double,Title:string>>"


def fenced_block(c: Column) -> Column:
    """Text of the last fenced block, language word removed; null without a fence."""
    parts = F.split(c, FENCE)
    block = F.when(F.size(parts) >= 2, F.element_at(parts, F.size(parts) - 1))
    return F.regexp_replace(block, r"(?U)^\s*(json)?\s*|\s+$", "")


def scored_rows(c: Column, schema: str = ANSWER_ROWS) -> Column:
    """Rows of the answer; null where the block is missing or its JSON is bad."""
    return F.from_json(fenced_block(c), schema)
