"""The registry's relational tables to one wide, typed row per study of a country."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.functions.values import age_in_years, is_value
from trialweave.operators import aggregates, joins
from trialweave.operators.columns import learn_names, quoted
from trialweave.operators.filters import matches_or_missing

# Columns taken from the registry's tables, and the shape of an EU number.
STUDY_COLUMNS = [
    "official_title", "acronym", "phase", "study_type", "overall_status", "source", "source_class",
    "baseline_population", "enrollment", "enrollment_type", "number_of_arms", "number_of_groups",
    "why_stopped", "study_first_submitted_date", "start_month_year", "start_date", "start_date_type",
    "completion_month_year", "completion_date", "completion_date_type", "has_expanded_access",
    "expanded_access_nctid", "expanded_access_status_for_nctid", "expanded_access_type_individual",
    "expanded_access_type_intermediate", "expanded_access_type_treatment",
]
DESIGN_COLUMNS = [
    "allocation", "intervention_model", "intervention_model_description", "observational_model",
    "primary_purpose", "time_perspective", "masking", "masking_description", "subject_masked",
    "caregiver_masked", "investigator_masked", "outcomes_assessor_masked",
]
AGE_COLUMNS = ["minimum_age_num", "minimum_age_unit", "maximum_age_num", "maximum_age_unit"]
EU_NUMBER = r"^\d{4}-\d{6}-.*$"


def registry_extract(tables: Mapping[str, DataFrame], country: str, one_row: bool = False,
                     ordered: bool = True) -> DataFrame:
    """One wide row per study of a country.

    The country's studies are found first and every other table is thinned out to them
    before it is aggregated to one row per study and joined. ``id_information``,
    ``designs`` and ``calculated_values`` join as they are, so a study may repeat; with
    ``one_row`` each of them, and ``studies``, is first reduced to its least row per study, all
    columns in order. Columns a table lacks are left out.
    """
    here = tables["countries"].where((F.col("name") == country) & ~F.col("removed")).select("nct_id")

    def of_country(table: str) -> DataFrame:
        # A semi join asks for no distinct links, and making them so would hold memory once per table in a task.
        return joins.filter_by_link(tables[table], here, "nct_id", semi=True)

    def least(df: DataFrame) -> DataFrame:
        if not one_row:
            return df
        order = [F.col(c).asc_nulls_last() for c in df.columns if c != "nct_id"]
        return aggregates.dedup_keep_first(df, ["nct_id"], order) if order else df.distinct()

    def pick(df: DataFrame, names: list[str]) -> DataFrame:
        return least(df.select("nct_id", *[c for c in names if c in df.columns]))

    studies = joins.filter_by_link(pick(tables["studies"], STUDY_COLUMNS), here, "nct_id", semi=one_row)
    ids = of_country("id_information").where(matches_or_missing(F.col("id_value"), EU_NUMBER))

    def lists_of(table: str, columns: dict[str, str]) -> DataFrame:
        return aggregates.distinct_lists(of_country(table), ["nct_id"], columns)

    sides = [
        least(ids.select("nct_id", F.col("id_value").alias("eudract_id"))),
        joins.lists_through_dictionary(
            of_country("search_term_results"), tables["search_terms"], "nct_id", "search_term_id", "id",
            {"terms": "term", "grouping": "group"},
        ),
        pick(of_country("designs"), DESIGN_COLUMNS),
        lists_of("conditions", {"condition": "name"}),
        pick(of_country("calculated_values"), AGE_COLUMNS),
        lists_of("eligibilities", {"gender": "gender", "criteria": "criteria"}),
        lists_of("keywords", {"keys": "name"}),
        lists_of("interventions", {"interv": "name"}),
    ]
    wide = joins.star_left(studies, sides, "nct_id")
    return wide.orderBy(F.desc_nulls_last("study_first_submitted_date"), "nct_id") if ordered else wide


# Registry columns whose categories become indicators, and the column that holds the categories beyond the known ones.
CATEGORY_COLUMNS = ("allocation", "intervention_model", "masking")
OTHER_CATEGORIES = "other_categories"


def clean_registry(extract: DataFrame) -> DataFrame:
    """Names of the merged schema, category indicators, ages in years.

    The registry's known categories become a column each. Any other category of a study is an entry, such as
    ``masking_X``, of the map ``other_categories``, which needs no job and no list of names; ``spread_categories`` makes columns
    of the entries where the table is shown or written.
    """
    phase, allocation = F.col("phase"), F.col("allocation")
    gender = F.coalesce(F.col("gender"), F.array())

    def sex(value: str):
        # A study open to ALL is open to either sex.
        return F.arrays_overlap(gender, F.array(F.lit(value), F.lit("ALL")))

    # Category values of the registry.
    indicators = {
        "trial_Early_Phase_I": is_value(phase, "EARLY_PHASE1"),
        "trial_Phase_I": is_value(phase, "PHASE1", "PHASE1/PHASE2"),
        "trial_Phase_II": is_value(phase, "PHASE2", "PHASE1/PHASE2", "PHASE2/PHASE3"),
        "trial_Phase_III": is_value(phase, "PHASE3", "PHASE2/PHASE3"),
        "trial_Phase_IV": is_value(phase, "PHASE4"),
        "allocation_RANDOMIZED": is_value(allocation, "RANDOMIZED"),
        "allocation_NON_RANDOMIZED": is_value(allocation, "NON_RANDOMIZED"),
        "intervention_model_PARALLEL": is_value(F.col("intervention_model"), "PARALLEL"),
        "intervention_model_CROSSOVER": is_value(F.col("intervention_model"), "CROSSOVER"),
        "intervention_model_SINGLE_GROUP": is_value(F.col("intervention_model"), "SINGLE_GROUP"),
        "intervention_model_FACTORIAL": is_value(F.col("intervention_model"), "FACTORIAL"),
        "intervention_model_SEQUENTIAL": is_value(F.col("intervention_model"), "SEQUENTIAL"),
        "masking_NONE": is_value(F.col("masking"), "NONE"),
        "masking_SINGLE": is_value(F.col("masking"), "SINGLE"),
        "masking_DOUBLE": is_value(F.col("masking"), "DOUBLE"),
        "masking_TRIPLE": is_value(F.col("masking"), "TRIPLE"),
        "masking_QUADRUPLE": is_value(F.col("masking"), "QUADRUPLE"),
        "Gender_FEMALE": sex("FEMALE"),
        "Gender_MALE": sex("MALE"),
    }
    unknown = [F.when(~F.concat(F.lit(f"{c}_"), F.col(c)).isin(list(indicators)), F.concat(F.lit(f"{c}_"), F.col(c)))
               for c in CATEGORY_COLUMNS]
    found = F.array_distinct(F.filter(F.array(*unknown), lambda x: x.isNotNull()))
    others = {OTHER_CATEGORIES: F.map_from_arrays(found, F.transform(found, lambda _: F.lit(True)))}
    # An empty list is no value, so it must not win over the EU register's condition.
    lists_as_text = {c: F.nullif(F.array_join(c, " | "), F.lit("")) for c in ("terms", "grouping", "condition")}
    ages = {
        "minimum_age_num": age_in_years(F.col("minimum_age_num"), F.col("minimum_age_unit")),
        "maximum_age_num": age_in_years(F.col("maximum_age_num"), F.col("maximum_age_unit")),
    }
    return (
        extract.withColumns({**indicators, **others, **lists_as_text, **ages})
        .withColumnsRenamed({"eudract_id": "eudract_nr", "official_title": "title", "acronym": "Protocol"})
        .drop("phase", "allocation", "gender", "minimum_age_unit", "maximum_age_unit")
    )


def spread_categories(df: DataFrame, name: str = OTHER_CATEGORIES, limit: int = 5000) -> DataFrame:
    """The entries of the map as one boolean column each, in place of it; null where the row has no map.

    One aggregation of the map's keys learns the names; more than ``limit`` are an error, never a silent cut.
    """
    keys = learn_names(df, F.map_keys(F.col(name)), limit)
    known = F.col(name).isNotNull()
    columns = [F.when(known, F.map_contains_key(name, k)).alias(k) for k in keys]
    return df.select(*[quoted(c) for c in df.columns if c != name], *columns)
