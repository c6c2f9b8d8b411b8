"""Both EU registers to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.functions import lists, text
from trialweave.functions.values import to_day, to_flag, to_number
from trialweave.operators import aggregates, columns, sets

# Labels of the older register and items of the newer one, by output flag.
DESIGN_FLAGS = {
    "trial_design_Controlled": "Controlled",
    "trial_design_Randomised": "Randomised",
    "trial_design_Open": "Open",
    "trial_design_Single_blind": "Single_blind",
    "trial_design_Double_blind": "Double_blind",
    "trial_design_Parallel_group": "Parallel_group",
    "trial_design_Cross_over": "Cross_over",
    "trial_design_Other_medicinal_product": "Other_medicinal_product(s)",
    "trial_design_Placebo": "Placebo",
}
SCOPE_FLAGS = {
    "trial_scope_Diagnosis": "Diagnosis",
    "trial_scope_Prophylaxis": "Prophylaxis",
    "trial_scope_Therapy": "Therapy",
    "trial_scope_Safety": "Safety",
    "trial_scope_Efficacy": "Efficacy",
    "trial_scope_Pharmacokinetic": "Pharmacokinetic",
    "trial_scope_Pharmacodynamic": "Pharmacodynamic",
    "trial_scope_Bioequivalence": "Bioequivalence",
    "trial_scope_Dose_response": "Dose_response",
    "trial_scope_Pharmacogenetic": "Pharmacogenetic",
    "trial_scope_Pharmacogenomic": "Pharmacogenomic",
}
PHASE_FLAGS = {
    "trial_phase_First_administration_to_humans": "First_administration_to_humans",
    "trial_phase_Bioequivalence_study": "Bioequivalence_study",
    "trial_Phase_I": "Human_pharmacology_(Phase_I)",
    "trial_Phase_II": "Therapeutic_exploratory_(Phase_II)",
    "trial_Phase_III": "Therapeutic_confirmatory_(Phase_III)",
    "trial_Phase_IV": "Therapeutic_use_(Phase_IV)",
}
PHASE_WORDS = {
    "trial_Phase_I": "Phase I",
    "trial_Phase_II": "Phase II",
    "trial_Phase_III": "Phase III",
    "trial_Phase_IV": "Phase IV",
}
ARMS = "Number_of_treatment_arms_in_the_trial"
# The older register's columns for the youngest band, first known one first.
MINOR_COLUMNS = [
    "Age_Trial_has_subjects_under_18",
    "Age_Adolescents_(12-17_years)",
    "Age_Children_(2-11years)",
    "Age_Infants_and_toddlers_(28_days-23_months)",
    "Age_Newborns_(0-27_days)",
    "Age_Preterm_newborn_infants_(up_to_gestational_age_<_37_weeks)",
]
ADULT_COLUMN = "Age_Adults_(18-64_years)"
ELDERLY_COLUMN = "Age_Elderly_(>=65_years)"
NEW_AGES = {"Age_0_17_years": "0-17 years", "Age_18_64_years": "18-64 years", "Age_65p_years": "65+ years"}

# Text columns of the registers.
TEXT_COLUMNS = [
    "title", "eudract_nr", "nct_nr", "Protocol", "Sponsor", "Sponsor_type", "condition",
    "therapeutic_area", "inclusion_crt", "exclusion_crt", "nr_enrolled", "status", "url",
    "start_date", "end_date",
]


def _given(df: DataFrame, name: str) -> Column:
    """A column the frame may lack."""
    return columns.quoted(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _labelled(mapped: str, label: str) -> Column:
    """Value under a label, written with blanks or with underscores."""
    plain = label.replace("_", " ")
    first = F.try_element_at(mapped, F.lit(plain))
    return first if plain == label else F.coalesce(first, F.try_element_at(mapped, F.lit(label)))


def _first_number(df: DataFrame, names: list[str]) -> Column:
    """First of the columns that holds a number; the others are passed over."""
    present = [_given(df, n) for n in names if n in df.columns]
    return F.coalesce(*[F.when(to_number(c).isNotNull(), c) for c in present], F.lit(None).cast("string"))


def older_register(raw: DataFrame) -> DataFrame:
    """Older register: flags sit in JSON objects and in one column per age label."""
    df = columns.drop_null_rows(raw)
    objects = {"__design": "trial_design", "__scope": "trial_scope", "__phase": "trial_phase"}
    mapped = df.withColumns({out: lists.json_object(_given(df, c)) for out, c in objects.items()})
    # The texts behind the flags are looked up once, in a step of their own.
    answers = {
        **{out: _labelled("__design", key) for out, key in DESIGN_FLAGS.items()},
        **{out: _labelled("__scope", key) for out, key in SCOPE_FLAGS.items()},
        **{out: _labelled("__phase", key) for out, key in PHASE_FLAGS.items()},
        "Age_0_17_years": _first_number(df, MINOR_COLUMNS),
        "Age_18_64_years": _given(df, ADULT_COLUMN),
        "Age_65p_years": _given(df, ELDERLY_COLUMN),
        "Gender_F": _given(df, "Gender_F"),
        "Gender_M": _given(df, "Gender_M"),
    }
    texts = mapped.select(
        *[_given(df, c).alias(c) for c in TEXT_COLUMNS],
        *[c.alias(n) for n, c in answers.items()],
        _labelled("__design", ARMS).alias("eu_arms"),
    )
    return texts.withColumns({name: to_flag(F.col(name)) for name in answers})


def newer_register(raw: DataFrame) -> DataFrame:
    """Newer register: ages and sexes as delimited text, phases as a description.

    Columns ``Gender_F``/``Gender_M`` and ``Age_<band>`` of the collector count where the
    delimited ones are missing.
    """
    df = columns.drop_null_rows(raw)

    def listed(column: str, item: str, instead: str) -> Column:
        direct = to_flag(_given(df, instead))
        boolean = _given(df, instead).try_cast("boolean")
        if column not in df.columns:
            return F.coalesce(direct, boolean)
        cell = columns.quoted(column)
        return F.coalesce(F.when(cell.isNotNull(), lists.has_item(cell, item) == 1), direct, boolean, F.lit(False))

    described = _given(df, "trial_phase_desc")
    return df.select(
        *[_given(df, c).alias(c) for c in TEXT_COLUMNS],
        *[F.coalesce(text.has_word(described, words), F.lit(False)).alias(out) for out, words in PHASE_WORDS.items()],
        *[listed("Age", item, "Age_" + item.replace(" ", "_")).alias(out) for out, item in NEW_AGES.items()],
        listed("Gender", "Female", "Gender_F").alias("Gender_F"),
        listed("Gender", "Male", "Gender_M").alias("Gender_M"),
    )


def harmonise(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Both registers stacked, dates and lists cleaned, sponsor types united per sponsor."""
    both = sets.union_by_name(older_register(older), newer_register(newer))

    def cleaned(name: str) -> Column:
        return text.strip(lists.unique_inside(F.col(name)))

    both = both.withColumns({
        "start_date": to_day(F.col("start_date")),
        "end_date": to_day(F.col("end_date")),
        "Sponsor": cleaned("Sponsor"),
        "Sponsor_type": cleaned("Sponsor_type"),
        **{c: F.coalesce(c, F.lit(False)) for c in PHASE_WORDS},
    })
    types = aggregates.merge_lists(both, "Sponsor", "Sponsor_type", out="Sponsor_type")
    return both.drop("Sponsor_type").join(types, "Sponsor", "left")
