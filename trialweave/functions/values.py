"""Numbers, dates, flags and fallbacks. Bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, edges and runs alike.
SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same inside a pattern that starts with (?U); Java's \s lacks four of them.
SPACE_CLASS = r"[\s\x1c-\x1f]"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(c, F.lit(SPACE))


def to_number(c: Column) -> Column:
    """Text to double.

    A cast alone would also accept the Java suffixes of ``1d`` and ``1f``.
    """
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_whole_number(c: Column) -> Column:
    """Text to bigint; text with a fraction gives null."""
    text = c.cast("string")
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast("bigint"))


def to_day(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date with an explicit pattern."""
    return F.try_to_date(c, fmt)


def to_flag(c: Column) -> Column:
    """``1``/``0``, also as ``1.0`` or with white space, to a boolean; else null."""
    text = c.cast("string")
    # Nearly every flag is written plainly; the patterns see the others only.
    return (
        F.when(text == "1", True).when(text == "0", False)
        .when(text.rlike(r"^\s*\+?0*1(\.0*)?\s*$"), True).when(text.rlike(r"^\s*[+-]?0+(\.0*)?\s*$"), False)
    )


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value of c)`` with ``c`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(c), lambda value: use(value)), F.lit(0))


def yes_no(c: Column) -> Column:
    """Whole values ``Yes``/``No`` to ``1``/``0`` text, other text kept."""
    return F.when(c == "Yes", "1").when(c == "No", "0").otherwise(c)


def null_if(c: Column, value) -> Column:
    """Turn one value into null."""
    return F.nullif(c, F.lit(value))


def first_known(*columns: Column) -> Column:
    """First non-null value."""
    return F.coalesce(*columns)


def earliest(*columns: Column) -> Column:
    """Smallest non-null value of a row."""
    return F.least(*columns)


def latest(*columns: Column) -> Column:
    """Largest non-null value of a row."""
    return F.greatest(*columns)


def holds(condition: Column) -> Column:
    """A condition that reads as false where a value is missing."""
    return F.coalesce(condition, F.lit(False))


def is_value(c: Column, *values: str) -> Column:
    """Indicator of a category: true, or false also where the category is missing."""
    return holds(c.isin(*values))


def age_in_years(number: Column, unit: Column) -> Column:
    """Age in years from a number and its unit; an unknown unit gives null."""
    value = number.cast("double")
    return (
        F.when(unit == "Years", value)
        .when(unit == "Months", value / 12)
        .when(unit == "Days", value / 365)
    )


def age_bands(low: Column, high: Column, overlap: bool = False) -> dict[str, Column]:
    """Flags for the three age bands of a study's age range.

    The middle band asks that the whole range lies inside it; ``overlap`` asks only for
    a common part, as the youngest band always does. A missing bound gives false.
    """
    middle = (low <= 64) & (high >= 18) if overlap else (high <= 64) & (low >= 18)
    return {
        "Age_0_17_years": holds((low <= 17) & (high >= 0)),
        "Age_18_64_years": holds(middle),
        "Age_65p_years": holds(low >= 65),
    }


def flag_with_fallback(first: Column, second: Column, negated: Column) -> Column:
    """``first``, else ``second`` if true, else the Kleene negation of ``negated``."""
    return F.coalesce(first, null_if(second, False), ~negated)


def keyword_flag(c: Column, false_words: Sequence[str], true_words: Sequence[str],
                 ignore_case: bool = True) -> Column:
    """Three-valued flag: a false word wins over a true word, neither gives null."""
    text = F.lower(c) if ignore_case else c

    def any_of(words):
        found = F.lit(False)
        for word in words:
            found = found | text.contains(word.lower() if ignore_case else word)
        return found

    return F.when(any_of(false_words), False).when(any_of(true_words), True)


def split_ratio(c: Column) -> tuple[Column, Column]:
    """``"a/b"`` to the number ``a`` and the text ``b``; without a slash only a number."""
    parts = F.split(c, "/")
    has_slash = c.contains("/")
    return (
        to_whole_number(F.when(has_slash, parts[0]).otherwise(c)),
        F.when(has_slash, F.element_at(parts, -1)),
    )


def origin(study_id: Column, sponsor: Column, source: Column | None = None,
           labels: Mapping[str, str] | None = None) -> Column:
    """Which register a merged row came from, judged by the identifiers it carries."""
    # Labels of the registers.
    names = {"registry": "clinicaltrials.gov", "eu": "clinicaltrials.eu", "none": "unknown",
             **(labels or {})}
    eu = sponsor.isNotNull() if source is None else sponsor.isNotNull() | source.isNotNull()
    return (
        F.when(study_id.isNotNull(), names["registry"]).when(eu, names["eu"]).otherwise(names["none"])
    )
