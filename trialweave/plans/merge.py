"""EU registers and registry merged into one table of studies, and programmes beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.functions import lists, text
from trialweave.functions.values import (
    age_bands, earliest, flag_with_fallback, latest, origin, to_day, to_number,
)
from trialweave.operators import columns, joins
from trialweave.plans.registry import OTHER_CATEGORIES

# Column names of the registers and of the published table.
# Which side wins where both registers have a column of the same meaning. "R" is the
# registry, "E" the EU registers; the first known value counts.
PRECEDENCE: dict[str, list[tuple[str, str]]] = {
    "title": [("R", "title"), ("E", "title")],
    "Protocol": [("R", "Protocol"), ("E", "Protocol")],
    "condition": [("R", "condition"), ("E", "condition")],
    "trial_Phase_I": [("R", "trial_Phase_I"), ("E", "trial_Phase_I")],
    "trial_Phase_II": [("R", "trial_Phase_II"), ("E", "trial_Phase_II")],
    "trial_Phase_III": [("R", "trial_Phase_III"), ("E", "trial_Phase_III")],
    "trial_Phase_IV": [("R", "trial_Phase_IV"), ("E", "trial_Phase_IV")],
    "Sponsor": [("E", "Sponsor"), ("R", "source")],
    "Sponsor_type": [("E", "Sponsor_type"), ("R", "source_class")],
    "status": [("E", "status"), ("R", "overall_status")],
    "trial_design_Parallel_group": [("E", "trial_design_Parallel_group"), ("R", "intervention_model_PARALLEL")],
    "trial_design_Cross_over": [("E", "trial_design_Cross_over"), ("R", "intervention_model_CROSSOVER")],
    "masking_OPEN": [("R", "masking_NONE"), ("E", "trial_design_Open")],
    "masking_SINGLE": [("R", "masking_SINGLE"), ("E", "trial_design_Single_blind")],
    "masking_DOUBLE": [("R", "masking_DOUBLE"), ("E", "trial_design_Double_blind")],
}
# Columns taken over unchanged from the one side that has them.
KEPT = {
    "R": ["nct_id", "study_type", "primary_purpose", "intervention_model", "study_first_submitted_date",
          "has_expanded_access", "expanded_access_nctid", "expanded_access_status_for_nctid",
          "expanded_access_type_individual", "expanded_access_type_intermediate", "expanded_access_type_treatment",
          "baseline_population", "enrollment_type", "number_of_groups", "why_stopped", "start_month_year",
          "start_date_type", "completion_month_year", "completion_date_type", "intervention_model_description",
          "observational_model", "time_perspective", "subject_masked", "caregiver_masked", "investigator_masked",
          "outcomes_assessor_masked", OTHER_CATEGORIES],
    "E": ["nct_nr", "url", "trial_design_Other_medicinal_product", "trial_design_Placebo",
          "trial_scope_Diagnosis", "trial_scope_Prophylaxis", "trial_scope_Therapy", "trial_scope_Safety",
          "trial_scope_Efficacy", "trial_scope_Pharmacokinetic", "trial_scope_Pharmacodynamic",
          "trial_scope_Bioequivalence", "trial_scope_Dose_response", "trial_scope_Pharmacogenetic",
          "trial_scope_Pharmacogenomic", "trial_phase_First_administration_to_humans",
          "trial_phase_Bioequivalence_study"],
}


def merge_registries(eu: DataFrame, registry: DataFrame, overlapping_ages: bool = False) -> DataFrame:
    """Full outer join on the EU number with a rule per column; studies without a number stay alone.

    Indicators of the registry's categories beyond those that the rules merge are kept under their own names, those that the
    cleaning does not know as entries of ``other_categories`` (see :func:`trialweave.plans.registry.spread_categories`).

    ``eu`` comes from :func:`trialweave.plans.eu.harmonise` and ``registry`` from
    :func:`trialweave.plans.registry.clean_registry`.
    """
    left = eu.withColumnsRenamed({c: f"E_{c}" for c in eu.columns if c != "eudract_nr"})
    right = registry.withColumnsRenamed({c: f"R_{c}" for c in registry.columns if c != "eudract_nr"})
    joined = joins.full_outer_coalesce(left, right, "eudract_nr")
    have = set(joined.columns)

    def side(which: str, name: str) -> Column:
        """A side's column, null where the source came without it."""
        return F.col(f"{which}_{name}") if f"{which}_{name}" in have else F.lit(None)

    def E(name: str) -> Column:
        return side("E", name)

    def R(name: str) -> Column:
        return side("R", name)

    def ruled(name: str) -> Column:
        return F.coalesce(*[side(which, source) for which, source in PRECEDENCE[name]])

    low, high = R("minimum_age_num"), R("maximum_age_num")
    bound_known = {
        "Age_0_17_years": low.isNotNull() | high.isNotNull(),
        "Age_18_64_years": low.isNotNull() | high.isNotNull(),
        "Age_65p_years": low.isNotNull(),
    }
    # The EU register's own flag counts where the registry gives no age.
    ages = {
        name: F.coalesce(F.when(bound_known[name], band), E(name), F.lit(False))
        for name, band in age_bands(low, high, overlapping_ages).items()
    }

    def criteria_list(name: str, kind: str) -> Column:
        # Every criteria text of a study counts; without one the registry says nothing.
        texts = R("criteria").cast("array<string>")
        found = F.array_distinct(F.flatten(F.transform(texts, lambda c: text.criteria(c, kind))))
        known = F.filter(found, lambda item: item.isNotNull())
        own = F.when(F.size(texts) > 0, F.when(F.size(known) > 0, known).otherwise(F.array(F.lit(None).cast("string"))))
        return F.coalesce(lists.parse_literal(E(name)), lists.ensure_list(E(name)), own)

    merged = {
        **{name: ruled(name) for name in PRECEDENCE if name != "condition"},
        "start_date": earliest(E("start_date"), R("start_date").try_cast("date")),
        "end_date": latest(E("end_date"), R("completion_date").try_cast("date")),
        "trial_Early_Phase_I": F.coalesce(R("trial_Early_Phase_I"), F.lit(False)),
        "therapeutic_area": text.terms([E("therapeutic_area"), R("terms"), R("grouping"), ruled("condition")]),
        "keywords": lists.ensure_list(R("keys"), is_array=True),
        "interventions": lists.ensure_list(R("interv"), is_array=True),
        "inclusion_crt": criteria_list("inclusion_crt", "inclusion"),
        "exclusion_crt": criteria_list("exclusion_crt", "exclusion"),
        "enrollment": F.coalesce(to_number(R("enrollment")), to_number(E("nr_enrolled"))),
        "Gender_F": F.coalesce(E("Gender_F"), R("Gender_FEMALE"), F.lit(False)),
        "Gender_M": F.coalesce(E("Gender_M"), R("Gender_MALE"), F.lit(False)),
        **ages,
        "trial_design_Randomised": flag_with_fallback(
            E("trial_design_Randomised"), R("allocation_RANDOMIZED"), R("allocation_NON_RANDOMIZED")),
        "trial_design_Controlled": F.coalesce(
            E("trial_design_Controlled"), ~R("intervention_model_SINGLE_GROUP")),
        "number_of_arms": F.coalesce(to_number(R("number_of_arms")), to_number(E("eu_arms"))).try_cast("int"),
        "source_dataset": origin(R("nct_id"), ruled("Sponsor_type")),
    }
    kept = [side(which, c).alias(c) for which, names in KEPT.items() for c in names if f"{which}_{c}" in have]
    used = {source for rule in PRECEDENCE.values() for _, source in rule} | set(KEPT["R"])
    kept += [F.col(c).alias(c[2:]) for c in joined.columns
             if c.startswith(("R_intervention_model_", "R_masking_")) and c[2:] not in used | {"masking_description"}]
    return joined.select("eudract_nr", *kept, *[c.alias(n) for n, c in merged.items()])


def align_programmes(programmes: DataFrame, schema: T.StructType) -> DataFrame:
    """Early-access programmes in the schema of the merged table."""
    # Column names, date pattern and label of the published table.
    named = columns.rename(programmes, {
        "Nome": "title", "data_decisao": "start_date", "n_doentes": "enrollment",
    })
    # The schema has lists where a programme has one text: its substance and its details.
    typed = named.withColumns({
        "interventions": lists.ensure_list(F.col("DCI")),
        "therapeutic_area": lists.ensure_list(F.col("detalhes")),
        "start_date": to_day(F.col("start_date"), "dd/MM/yyyy"),
        "enrollment": to_number(F.col("enrollment")),
    })
    return columns.align_schema(typed, schema, {"source_dataset": "PAP Infarmed"})
