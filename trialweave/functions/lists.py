"""Lists in cells: parsing, joining, tagging, JSON."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialweave.functions.values import bind, strip

_TEXT_LIST = "array<string>"
# Fixed value: the mark of a list stored as text.
LIST_TAG = "__list__"
# Up to the end of the text every quoted string is whole.
_OUTSIDE_QUOTES = r"""(?:[^'"]++|'[^']*+'|"[^"]*+")*+$"""


def parse_literal(c: Column) -> Column:
    """``["a"]`` or ``['a', None]`` to an array; null where the text is no list.

    Bare ``None``/``True``/``False`` are tried as JSON words only after a plain parse
    fails. A word counts as bare if only whole quoted strings follow it, so the same
    words inside quotes stay untouched.
    """
    options = {"allowSingleQuotes": "true"}
    json_words = c
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        json_words = F.regexp_replace(json_words, rf"([\[,]\s*){word}(?=\s*[,\]]{_OUTSIDE_QUOTES})", f"$1{json_word}")
    parsed = F.coalesce(
        F.from_json(c, _TEXT_LIST, options), F.from_json(json_words, _TEXT_LIST, options)
    )
    return F.when(c.rlike(r"(?s)^\s*\[.*\]\s*$"), parsed)


def split_at(c: Column, separator: str) -> Column:
    """Split on a literal separator, whatever its characters mean in a pattern."""
    return F.split(c, re.escape(separator))


def split_clean(c: Column, separator: str = ",") -> Column:
    """Split on a literal separator, trim, drop blanks."""
    items = F.transform(split_at(c, separator), strip)
    return F.filter(items, lambda item: item != "")


def to_list(c: Column) -> Column:
    """Text to list: null gives ``[]``, a list literal its items, else split on commas."""
    return F.coalesce(parse_literal(c), split_clean(c), F.array().cast(_TEXT_LIST))


def ensure_list(c: Column, is_array: bool = False) -> Column:
    """Array kept, null kept, single value trimmed and wrapped."""
    if is_array:
        return c
    return F.when(c.isNotNull(), F.array(strip(c.cast("string"))))


def to_text(c: Column, separator: str = ", ", null_item: str | None = None) -> Column:
    """Array to text; null items are left out unless ``null_item`` says how to show them."""
    return F.array_join(c, separator) if null_item is None else F.array_join(c, separator, null_item)


def unique_inside(c: Column, separator: str = ", ") -> Column:
    """Remove repeats inside a delimited text, first occurrence kept in place."""
    return F.array_join(F.array_distinct(split_at(c, separator)), separator)


def bracket_items(c: Column) -> Column:
    """Items of bracketed text such as ``['a', "b"]`` without any parser.

    Outer brackets go, the rest is split on commas, then space and quotes are cut.
    """
    body = F.regexp_replace(c, r"^[\[\]]+|[\[\]]+$", "")
    return F.transform(
        F.split(body, ","),
        lambda item: _cut(_cut(strip(item), "'"), '"'),
    )


def tag_encode(c: Column) -> Column:
    """Array to tagged text, null elements and null arrays kept."""
    return F.concat(F.lit(LIST_TAG), F.to_json(c))


def tag_decode(c: Column, keep_bad: bool = True) -> Column:
    """Tagged text back to an array.

    Untagged text becomes an array of itself. Tagged text with a bad list is kept as
    the single item (``keep_bad``) or gives null.
    """
    tagged = c.startswith(LIST_TAG)
    body = F.substring(c, len(LIST_TAG) + 1, 2**31 - 1)
    whole = F.when(c.isNotNull(), F.array(c))
    decoded = F.from_json(body, _TEXT_LIST)
    return F.when(tagged, F.coalesce(decoded, whole) if keep_bad else decoded).otherwise(whole)


def pairs_to_map(pairs: Column) -> Column:
    """Array of (key, value) structs to a map; of a repeated key the last value counts."""
    def build(found: Column) -> Column:
        keys = F.transform(found, lambda p: p["key"])
        once = F.array_distinct(keys)
        last = F.transform(once, lambda k: F.element_at(F.filter(found, lambda p: p["key"] == k), -1)["value"])
        return F.when(
            F.size(once) == F.size(keys), F.map_from_arrays(keys, F.transform(found, lambda p: p["value"]))
        ).otherwise(F.map_from_arrays(once, last))

    return bind(pairs, build)


def json_map(c: Column) -> Column:
    """Flat JSON object to a map whose keys are trimmed, with ``_`` for blanks."""
    return pairs_to_map(F.transform(
        F.map_entries(F.from_json(c, "map<string,string>")),
        lambda e: F.struct(F.replace(strip(e["key"]), F.lit(" "), F.lit("_")).alias("key"),
                           e["value"].alias("value")),
    ))


def json_object(c: Column) -> Column:
    """Flat JSON object to a map with trimmed keys; rebuilt only where a key needs it."""
    def trimmed(found: Column) -> Column:
        odd = F.exists(F.map_keys(found), lambda k: k != strip(k))
        pairs = F.transform(F.map_entries(found), lambda e: F.struct(strip(e["key"]).alias("key"), e["value"].alias("value")))
        return F.when(odd, pairs_to_map(pairs)).otherwise(found)

    return bind(F.from_json(c, "map<string,string>"), trimmed)


def has_item(c: Column, value: str, separator: str = ", ") -> Column:
    """1 if a delimited text holds the item, else 0, also for null text."""
    found = F.array_contains(split_at(c, separator), value)
    return F.when(found, 1).otherwise(0)


def zip_fields(headers: Column, cells: Column, fields: Sequence[str]) -> dict[str, Column]:
    """Name cells by position: the i-th header stands for the i-th field.

    Cells beyond the headers, and headers beyond the fields, are ignored.
    """
    return {
        name: F.when(F.size(headers) > i, F.get(cells, F.lit(i))) for i, name in enumerate(fields)
    }


def _cut(c: Column, mark: str) -> Column:
    return F.regexp_replace(c, f"^{mark}+|{mark}+$", "")
