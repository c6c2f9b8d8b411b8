"""Faceted search over studies and its table of details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.operators.columns import select_available
from trialweave.operators.filters import (
    any_item_contains, cell_contains, flag_choice, is_in_ignoring_case, matches, when_present, where_all,
)

# Choices of the search form and the flags behind them.
AGE_FLAGS = {"0-17 years": "Age_0_17_years", "18-64 years": "Age_18_64_years", "65+ years": "Age_65p_years"}
SEX_FLAGS = {"Female": "Gender_F", "Male": "Gender_M"}
DETAILS = ["title", "start_date", "therapeutic_area", "interventions", "study_type", "status"]


def faceted_search(studies: DataFrame, age: str | None = None, sex: str | None = None,
                   condition: str | None = None, intervention: str | None = None,
                   keyword: str | None = None, outcome: str | None = None,
                   study_type: str | None = None, status: str | None = None,
                   literal_status: bool = False) -> DataFrame:
    """Studies that meet every facet given; one predicate, built once.

    An outcome asks nothing where the table has no outcome measures.
    """
    def flag(choices: dict[str, str], choice: str | None):
        return flag_choice(F.col(choices[choice]), True) if choice else None

    def is_list(name: str) -> bool:
        return isinstance(studies.schema[name].dataType, T.ArrayType)

    return where_all(studies, [
        flag(AGE_FLAGS, age),
        flag(SEX_FLAGS, sex),
        any_item_contains(F.col("therapeutic_area"), condition) if condition else None,
        any_item_contains(F.col("interventions"), intervention) if intervention else None,
        cell_contains(F.col("keywords"), keyword, is_list("keywords")) if keyword else None,
        when_present(studies, "outcome_measures",
                     lambda c: cell_contains(c, outcome, is_list("outcome_measures"))) if outcome else None,
        is_in_ignoring_case(F.col("study_type"), [study_type]) if study_type else None,
        matches(F.col("status"), status, literal_status) if status else None,
    ])


def details(found: DataFrame, *ties: str) -> DataFrame:
    """The table of details, latest start first."""
    ordered = found.orderBy(F.desc_nulls_last("start_date"), *ties)
    return select_available(ordered, DETAILS)
