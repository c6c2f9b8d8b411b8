"""Frames behind the overview and the programme report.

Each report is one pass: a row becomes the (section, label, weight) entries it counts
for, and a single aggregation adds them up. Entries combine on the map side, so what is
shuffled is as small as the report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.functions.values import holds, to_number
from trialweave.operators import aggregates
from trialweave.operators.columns import select_available
from trialweave.operators.filters import (
    any_item_equals, any_known, flag_choice, is_in, is_in_ignoring_case, matches, where_all,
)
from trialweave.sources import files

_ENTRY = "array<struct<section:string,label:string,weight:double>>"


def _entry(section: str, label: Column, weight: Column | None = None) -> Column:
    return F.struct(F.lit(section).alias("section"), label.cast("string").alias("label"),
                    (F.lit(1.0) if weight is None else weight).alias("weight"))


def _flag(section: str, label: str, condition: Column) -> Column:
    """Weighs 1 or 0, so a flag that is never true still shows with a total of 0."""
    return _entry(section, F.lit(label), F.when(holds(condition), 1.0).otherwise(0.0))


def add_up(df: DataFrame, entries: Sequence[Column], lists: Mapping[str, Column] | None = None) -> DataFrame:
    """(section, label, total) of all entries; entries without label are dropped."""
    def of_list(section: str, c: Column) -> Column:
        items = F.transform(c, lambda item: _entry(section, item)).cast(_ENTRY)
        return F.coalesce(items, F.array().cast(_ENTRY))

    single = F.array(*entries).cast(_ENTRY)
    many = [of_list(section, c) for section, c in (lists or {}).items()]
    return (
        df.select(F.inline(F.concat(single, *many)))
        .where("label IS NOT NULL")
        .groupBy("section", "label")
        .agg(F.sum("weight").cast("long").alias("total"))
    )


def filter_studies(df: DataFrame, study_types: Sequence[str] = (), areas: Sequence[str] = (),
                   interventions: Sequence[str] = ()) -> DataFrame:
    """The overview's filters; empty choices and absent columns ask nothing."""
    def when(chosen, name, predicate):
        return predicate(F.col(name), chosen) if chosen and name in df.columns else None

    return where_all(df, [
        when(study_types, "study_type", is_in_ignoring_case),
        when(areas, "therapeutic_area", any_item_equals),
        when(interventions, "interventions", any_item_equals),
    ])


# Sizes of the published charts, and columns of the published tables.
CHART_SIZES = {"area": 30, "sponsor type": 10, "keyword": 10}
PROGRAMME_CHART_SIZES = {"substance": 10}
EXPORTED = ["title", "start_date", "source_dataset", "therapeutic_area", "enrollment"]
PROGRAMME_COLUMNS = ["Nome", "DCI", "decisao", "data_decisao", "n_doentes", "PAP_act", "c_custos"]


def overview(studies: DataFrame, recruiting: str = "Recruiting", strict_case: bool = False,
             sizes: Mapping[str, int] | None = CHART_SIZES) -> DataFrame:
    """KPIs, trend and distributions as (section, label, total).

    Sections named in ``sizes`` keep that many of their most frequent labels; ``None`` keeps all.
    """
    have = set(studies.columns)
    status = F.col("status").contains(recruiting) if strict_case else matches(F.col("status"), recruiting, literal=True)
    entries = [
        _entry("kpi", F.lit("studies")),
        _entry("kpi", F.lit("participants"), F.coalesce(F.col("enrollment").cast("double"), F.lit(0.0))),
        _flag("kpi", "recruiting", status),
        _flag("kpi", "expanded access", F.col("has_expanded_access")),
        _flag("participation", "Female", F.col("Gender_F")),
        _flag("participation", "Male", F.col("Gender_M")),
        _flag("participation", "Children (0-17)", F.col("Age_0_17_years")),
        *[_flag("phase", label, F.col(c)) for label, c in {
            "Early I": "trial_Early_Phase_I", "I": "trial_Phase_I", "II": "trial_Phase_II",
            "III": "trial_Phase_III", "IV": "trial_Phase_IV"}.items()],
        *[_flag("masking", label, F.col(c)) for label, c in {
            "Open": "masking_OPEN", "Single-blind": "masking_SINGLE", "Double-blind": "masking_DOUBLE"}.items()],
        _entry("sponsor type", F.col("Sponsor_type")),
        _entry("criteria", F.when(any_known(F.col("inclusion_crt"), F.col("exclusion_crt")), "Has criteria")
               .otherwise("No criteria")),
    ]
    if "study_first_submitted_date" in have:
        entries.append(_entry("year", F.year("study_first_submitted_date")))
    entries += [_entry(section, F.col(c)) for section, c in {
        "study type": "study_type", "intervention model": "intervention_model"}.items() if c in have]
    lists = {s: F.col(c) for s, c in {"area": "therapeutic_area", "keyword": "keywords"}.items() if c in have}
    totals = add_up(studies, entries, lists)
    return aggregates.top_per_section(totals, "section", "total", "label", sizes) if sizes else totals


def export_table(studies: DataFrame, *ties: str) -> DataFrame:
    """The table of studies for download: the columns there are, lists as text, latest start first."""
    ordered = studies.orderBy(F.desc_nulls_last("start_date"), *ties) if "start_date" in studies.columns else studies
    return files.flatten_arrays(select_available(ordered, EXPORTED))


def enrolment_by_year(studies: DataFrame) -> DataFrame:
    """(start year, enrolment) of every study that has both."""
    return studies.select(
        F.year("start_date").alias("start_year"), to_number(F.col("enrollment")).alias("enrollment")
    ).dropna()


def filter_programmes(programmes: DataFrame, years: Sequence[int] | None = None,
                      decisions: Sequence[str] | None = None, active: bool | None = None,
                      with_costs: bool | None = None) -> DataFrame:
    """The programme report's filters over ``programmes`` with a date ``data_decisao``.

    Rows without year or decision never pass, as no choice lists them.
    """
    year, decision = F.year("data_decisao"), F.col("decisao")
    return where_all(programmes, [
        year.isNotNull() if years is None else is_in(year, years),
        decision.isNotNull() if decisions is None else is_in(decision, decisions),
        flag_choice(F.col("PAP_act"), active),
        flag_choice(F.col("c_custos"), with_costs),
    ])


def programme_table(programmes: DataFrame, *ties: str) -> DataFrame:
    """The table of programmes, latest decision first."""
    return select_available(programmes.orderBy(F.desc_nulls_last("data_decisao"), *ties), PROGRAMME_COLUMNS)


def programme_report(programmes: DataFrame, approved: str = "Deferido",
                     sizes: Mapping[str, int] | None = PROGRAMME_CHART_SIZES) -> DataFrame:
    """KPIs, decisions, years and the most frequent substances, all of them without ``sizes``.

    The share approved is given by two totals, the decisions known and those approved.
    """
    totals = add_up(programmes, [
        _entry("kpi", F.lit("programmes")),
        _flag("kpi", "decided", F.col("decisao").isNotNull()),
        _flag("kpi", "approved", F.col("decisao") == approved),
        _flag("kpi", "active", F.col("PAP_act")),
        _flag("kpi", "with costs", F.col("c_custos")),
        _entry("year", F.year("data_decisao")),
        _entry("decision", F.col("decisao")),
        _entry("substance", F.col("DCI")),
    ])
    return aggregates.top_per_section(totals, "section", "total", "label", sizes) if sizes else totals


def approved_share(report: DataFrame) -> DataFrame:
    """Share approved from a finished programme report, 0 where nothing is decided."""
    def total(label: str) -> Column:
        return F.sum(F.when((F.col("section") == "kpi") & (F.col("label") == label), F.col("total")))

    return report.agg(F.coalesce(F.try_divide(total("approved"), total("decided")), F.lit(0.0)).alias("share"))
