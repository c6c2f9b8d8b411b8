"""Whole jobs: extract, harmonise, clean, merge, align, report, search, shortlist."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from query_book import day, query
from query_book.raw import EU, PROGRAMMES, REGISTRY, ctes
from trialweave.functions import text
from trialweave.operators import ordering
from trialweave.functions.values import to_day
from trialweave.plans import eu, facets, merge, registry, reports, search, shortlist as short, two_sources
from trialweave.sources import files, landing
from trialweave.sources.html import programme_fields

COUNTRY = "NATION_3"


def extract(t, **options) -> DataFrame:
    return registry.registry_extract({n: r.frame(t) for n, r in REGISTRY.items()}, COUNTRY, **options)


def harmonised(t) -> DataFrame:
    return eu.harmonise(EU["older"].frame(t), EU["newer"].frame(t))


def merged(t) -> DataFrame:
    return merge.merge_registries(harmonised(t), registry.clean_registry(extract(t, ordered=False)))


def programmes(t) -> DataFrame:
    return programme_fields(PROGRAMMES.frame(t))


# --- SQL of the same jobs -------------------------------------------------------------

def lists_of(table: str, columns: dict[str, str]) -> str:
    chosen = ", ".join(f"list_sort(coalesce(list(DISTINCT {c}) FILTER ({c} IS NOT NULL), [])) AS {n}" for n, c in columns.items())
    return f"(SELECT nct_id, {chosen} FROM {table} GROUP BY 1)"


EXTRACT = rf"""{ctes(REGISTRY)},
here AS (SELECT nct_id FROM countries WHERE name = '{COUNTRY}' AND NOT removed),
extra AS (SELECT nct_id, id_value FROM id_information WHERE regexp_matches(id_value, '^\d{{4}}-\d{{6}}-.*$') OR id_value IS NULL),
links AS (SELECT nct_id, term, "group" FROM search_term_results JOIN search_terms ON search_term_id = id),
wide AS (SELECT s.*, i.id_value AS eudract_id, t.terms, t.grouping, d.* EXCLUDE (nct_id), c.condition, v.* EXCLUDE (nct_id),
         e.gender, e.criteria, k.keys, n.interv
  FROM studies s JOIN here h ON h.nct_id = s.nct_id LEFT JOIN extra i ON i.nct_id = s.nct_id
  LEFT JOIN {lists_of("links", {"terms": "term", "grouping": '"group"'})} t ON t.nct_id = s.nct_id
  LEFT JOIN designs d ON d.nct_id = s.nct_id LEFT JOIN {lists_of("conditions", {"condition": "name"})} c ON c.nct_id = s.nct_id
  LEFT JOIN calculated_values v ON v.nct_id = s.nct_id
  LEFT JOIN {lists_of("eligibilities", {"gender": "gender", "criteria": "criteria"})} e ON e.nct_id = s.nct_id
  LEFT JOIN {lists_of("keywords", {"keys": "name"})} k ON k.nct_id = s.nct_id
  LEFT JOIN {lists_of("interventions", {"interv": "name"})} n ON n.nct_id = s.nct_id)"""


def years(n: str, u: str) -> str:
    return f"CASE {u} WHEN 'Years' THEN {n}::DOUBLE WHEN 'Months' THEN {n} / 12 WHEN 'Days' THEN {n} / 365 END"


def is_any(column: str, *values: str) -> str:
    shown = ", ".join(f"'{v}'" for v in values)
    return f"coalesce({column} IN ({shown}), false)"


# Registry columns that reach the merged table as they are.
CARRIED = ["expanded_access_nctid", "expanded_access_status_for_nctid", "expanded_access_type_individual", "expanded_access_type_intermediate",
           "expanded_access_type_treatment", "baseline_population", "enrollment_type", "number_of_groups", "why_stopped", "start_month_year",
           "start_date_type", "completion_month_year", "completion_date_type", "intervention_model_description", "observational_model",
           "time_perspective", "subject_masked", "caregiver_masked", "investigator_masked", "outcomes_assessor_masked"]

CLEAN = f"""{EXTRACT},
clean AS (SELECT nct_id, eudract_id AS eudract_nr, official_title AS title, acronym AS "Protocol", study_type, overall_status, source,
  source_class, enrollment, number_of_arms, study_first_submitted_date, start_date, completion_date, has_expanded_access,
  intervention_model, primary_purpose, masking, masking_description, criteria, keys, interv, {", ".join(CARRIED)},
  nullif(array_to_string(terms, ' | '), '') AS terms, nullif(array_to_string(grouping, ' | '), '') AS grouping,
  nullif(array_to_string(condition, ' | '), '') AS condition,
  {is_any("phase", "EARLY_PHASE1")} AS p0, {is_any("phase", "PHASE1", "PHASE1/PHASE2")} AS p1,
  {is_any("phase", "PHASE2", "PHASE1/PHASE2", "PHASE2/PHASE3")} AS p2, {is_any("phase", "PHASE3", "PHASE2/PHASE3")} AS p3,
  {is_any("phase", "PHASE4")} AS p4, {is_any("allocation", "RANDOMIZED")} AS randomized,
  {is_any("allocation", "NON_RANDOMIZED")} AS non_randomized, {is_any("allocation", "ADAPTIVE")} AS adaptive, {is_any("intervention_model", "PARALLEL")} AS parallel,
  {is_any("intervention_model", "CROSSOVER")} AS crossover, {is_any("intervention_model", "SINGLE_GROUP")} AS single_group,
  {is_any("masking", "NONE")} AS mask_none, {is_any("masking", "SINGLE")} AS mask_single, {is_any("masking", "DOUBLE")} AS mask_double,
  {is_any("masking", "TRIPLE")} AS mask_triple, {is_any("masking", "QUADRUPLE")} AS mask_quadruple,
  {is_any("intervention_model", "FACTORIAL")} AS factorial, {is_any("intervention_model", "SEQUENTIAL")} AS sequential,
  list_has_any(coalesce(gender, []), ['FEMALE', 'ALL']) AS female, list_has_any(coalesce(gender, []), ['MALE', 'ALL']) AS male,
  {years("minimum_age_num", "minimum_age_unit")} AS low, {years("maximum_age_num", "maximum_age_unit")} AS high FROM wide)"""


def flag(c: str) -> str:
    return f"CASE try_cast({c} AS DOUBLE) WHEN 1 THEN true WHEN 0 THEN false END"


def design(column: str, key: str) -> str:
    return flag(f"""json_extract_string({column}, '$."{key}"')""")


def listed(column: str, item: str) -> str:
    return f"coalesce(list_contains(string_split({column}, ', '), '{item}'), false)"


def word(phrase: str) -> str:
    return rf"coalesce(regexp_matches(trial_phase_desc, '\b{phrase}\b'), false)"


def unique_items(column: str) -> str:
    split = f"string_split({column}, ', ')"
    return f"array_to_string(list_filter({split}, lambda x, i: list_position({split}, x) = i), ', ')"


def parsed_day(column: str) -> str:
    return f"try_strptime({column}, '%Y-%m-%d')::DATE"


HARMONISED = f"""{ctes(EU)},
stacked AS (
  SELECT eudract_nr, title, "Protocol", url, {unique_items('"Sponsor"')} AS sponsor, NULL AS types, status, {parsed_day("start_date")} AS start_date,
    {parsed_day("end_date")} AS end_date, NULL AS nr_enrolled, therapeutic_area, condition, inclusion_crt, exclusion_crt,
    {design("trial_design", "Controlled")} AS controlled, {design("trial_design", "Randomised")} AS randomised,
    {design("trial_design", "Open")} AS open, {design("trial_design", "Parallel group")} AS parallel_group,
    {design("trial_scope", "Therapy")} AS therapy, {design("trial_scope", "Dose response")} AS dose,
    coalesce({design("trial_phase", "Human pharmacology (Phase I)")}, false) AS p1, false AS p2, false AS p3,
    coalesce({design("trial_phase", "Therapeutic use (Phase IV)")}, false) AS p4,
    json_extract_string(trial_design, '$."Number of treatment arms in the trial"') AS eu_arms,
    {flag('coalesce("Age_Trial_has_subjects_under_18", "Age_Adolescents_(12-17_years)")')} AS minor,
    {flag('"Age_Adults_(18-64_years)"')} AS adult, NULL::BOOLEAN AS elderly, {flag('"Gender_F"')} AS female, {flag('"Gender_M"')} AS male FROM older
  UNION ALL
  SELECT eudract_nr, title, "Protocol", url, "Sponsor", {unique_items('"Sponsor_type"')}, status, {parsed_day("start_date")}, NULL, nr_enrolled,
    therapeutic_area, condition, inclusion_crt, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {word("Phase I")}, {word("Phase II")}, {word("Phase III")},
    {word("Phase IV")}, NULL, {listed('"Age"', "0-17 years")}, {listed('"Age"', "18-64 years")}, {listed('"Age"', "65+ years")},
    {listed('"Gender"', "Female")}, {listed('"Gender"', "Male")} FROM newer),
united AS (SELECT sponsor, array_to_string(list_sort(list(DISTINCT item)), ', ') AS sponsor_type
  FROM (SELECT sponsor, unnest(string_split(types, ', ')) AS item FROM stacked WHERE types IS NOT NULL) GROUP BY 1),
eu AS (SELECT s.* EXCLUDE (types), u.sponsor_type FROM stacked s LEFT JOIN united u ON u.sponsor = s.sponsor)"""


def term_items(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN [] WHEN {c} LIKE '[%]' AND json_valid({c}) THEN from_json({c}, '[\"VARCHAR\"]') "
            f"WHEN {c} LIKE '%|%' THEN string_split({c}, '|') WHEN {c} LIKE '%,%' THEN string_split({c}, ',') ELSE [{c}] END")


def clean_terms(items: str) -> str:
    return (rf"list_filter(list_transform({items}, lambda x: replace(trim(regexp_replace(trim(regexp_replace(lower(replace(replace(x, "
            rf"'Diseases [C] - ', ''), '''', '')), '\(.*\)', '')), '\[[a-z]+\d+\]', '')), 'neoplasms', 'neoplasm')), lambda x: x <> '')")


def criteria_items(c: str, kind: str) -> str:
    found = (rf"regexp_extract({c}, '(?is)inclusion criteria.*?:\s*(.*?)(?:exclusion criteria|$)', 1)" if kind == "inclusion"
             else rf"regexp_extract({c}, '(?is)exclusion criteria.*?:\s*(.*)$', 1)")
    body = (rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim({found}), '\r\n|\r|\n', '; ', 'g'), '[*•\\]', '', 'g'), "
            rf"'≥|≤|>=|<=', ' ', 'g'), '\s{{2,}}', ' ', 'g'), '^[; ]+|[; ]+$', '', 'g')")
    items = rf"list_filter(list_transform(regexp_split_to_array({body}, ';\s*|\d+\.\s+'), lambda x: trim(x)), lambda x: x <> '')"
    return f"CASE WHEN {c} IS NOT NULL THEN CASE WHEN len({items}) > 0 THEN {items} ELSE [NULL] END END"


def from_list_text(c: str) -> str:
    return f"from_json({c}, '[\"VARCHAR\"]')"


MERGED = f"""{CLEAN}, {HARMONISED},
both_sides AS (SELECT e.eudract_nr AS e_nr, r.eudract_nr AS r_nr, e.title AS e_title, r.title AS r_title, e."Protocol" AS e_protocol,
    r."Protocol" AS r_protocol, e.start_date AS e_start, r.start_date AS r_start, e.condition AS e_condition, r.condition AS r_condition,
    e.status AS e_status, e.p1 AS e1, e.p2 AS e2, e.p3 AS e3, e.p4 AS e4, r.p1 AS r1, r.p2 AS r2, r.p3 AS r3, r.p4 AS r4,
    e.female AS e_female, e.male AS e_male, r.female AS r_female, r.male AS r_male,
    e.* EXCLUDE (eudract_nr, title, "Protocol", start_date, condition, status, p1, p2, p3, p4, female, male),
    r.* EXCLUDE (eudract_nr, title, "Protocol", start_date, condition, p1, p2, p3, p4, female, male)
  FROM eu e FULL OUTER JOIN clean r ON e.eudract_nr = r.eudract_nr),
areas AS (SELECT *, {clean_terms(f"list_concat({term_items('therapeutic_area')}, {term_items('terms')}, {term_items('grouping')}, {term_items('coalesce(r_condition, e_condition)')})")} AS found FROM both_sides),
merged AS (SELECT coalesce(e_nr, r_nr) AS eudract_nr, nct_id, coalesce(r_title, e_title) AS title, coalesce(r_protocol, e_protocol) AS "Protocol",
  least(e_start, r_start) AS start_date, greatest(end_date, completion_date) AS end_date, coalesce(sponsor, source) AS "Sponsor",
  coalesce(sponsor_type, source_class) AS "Sponsor_type", coalesce(e_status, overall_status) AS status, study_type,
  intervention_model, primary_purpose, study_first_submitted_date, has_expanded_access, {", ".join(CARRIED)},
  mask_triple AS "masking_TRIPLE", mask_quadruple AS "masking_QUADRUPLE", single_group AS "intervention_model_SINGLE_GROUP",
  factorial AS "intervention_model_FACTORIAL", sequential AS "intervention_model_SEQUENTIAL", adaptive AS "allocation_ADAPTIVE", url, NULL::VARCHAR AS nct_nr, dose,
  coalesce(p0, false) AS "trial_Early_Phase_I", coalesce(r1, e1) AS "trial_Phase_I", coalesce(r2, e2) AS "trial_Phase_II",
  coalesce(r3, e3) AS "trial_Phase_III", coalesce(r4, e4) AS "trial_Phase_IV",
  nullif(list_filter(found, lambda x, i: list_position(found, x) = i), []) AS therapeutic_area, keys AS keywords, interv AS interventions,
  coalesce({from_list_text("inclusion_crt")}, {criteria_items("criteria[1]", "inclusion")}) AS inclusion_crt,
  coalesce({from_list_text("exclusion_crt")}, {criteria_items("criteria[1]", "exclusion")}) AS exclusion_crt,
  coalesce(enrollment::DOUBLE, try_cast(nr_enrolled AS DOUBLE)) AS enrollment,
  coalesce(e_female, r_female, false) AS "Gender_F", coalesce(e_male, r_male, false) AS "Gender_M",
  coalesce(CASE WHEN low IS NOT NULL OR high IS NOT NULL THEN coalesce(low <= 17 AND high >= 0, false) END, minor, false) AS "Age_0_17_years",
  coalesce(CASE WHEN low IS NOT NULL OR high IS NOT NULL THEN coalesce(high <= 64 AND low >= 18, false) END, adult, false) AS "Age_18_64_years",
  coalesce(CASE WHEN low IS NOT NULL THEN low >= 65 END, elderly, false) AS "Age_65p_years",
  coalesce(randomised, nullif(randomized, false), NOT non_randomized) AS "trial_design_Randomised",
  coalesce(controlled, NOT single_group) AS "trial_design_Controlled", coalesce(parallel_group, parallel) AS "trial_design_Parallel_group",
  crossover AS "trial_design_Cross_over", coalesce(mask_none, open) AS "masking_OPEN", dose AS "trial_scope_Dose_response", mask_single AS "masking_SINGLE",
  mask_double AS "masking_DOUBLE", therapy AS "trial_scope_Therapy", coalesce(number_of_arms, try_cast(eu_arms AS INTEGER)) AS number_of_arms,
  CASE WHEN nct_id IS NOT NULL THEN 'clinicaltrials.gov' WHEN coalesce(sponsor_type, source_class) IS NOT NULL THEN 'clinicaltrials.eu'
       ELSE 'unknown' END AS source_dataset FROM areas)"""

MERGED_COLUMNS = [
    "eudract_nr", "nct_id", "title", "Protocol", "Sponsor", "Sponsor_type", "status", "study_type", "intervention_model",
    "has_expanded_access", "trial_Early_Phase_I", "trial_Phase_I", "trial_Phase_II", "trial_Phase_III", "trial_Phase_IV", "enrollment",
    "Gender_F", "Gender_M", "Age_0_17_years", "Age_18_64_years", "Age_65p_years", "trial_design_Randomised",
    "trial_design_Controlled", "trial_design_Parallel_group", "trial_design_Cross_over", "masking_OPEN", "masking_SINGLE",
    "masking_DOUBLE", "trial_scope_Therapy", "number_of_arms", "source_dataset", "primary_purpose", *CARRIED, "masking_TRIPLE", "masking_QUADRUPLE",
    "intervention_model_SINGLE_GROUP", "intervention_model_FACTORIAL", "intervention_model_SEQUENTIAL", "url", "trial_scope_Dose_response",
]
MERGED_DAYS = ["start_date", "end_date", "study_first_submitted_date"]
MERGED_LISTS = ["therapeutic_area", "keywords", "interventions", "inclusion_crt", "exclusion_crt"]


# Every other plain column of the merged table is blank for a programme.
_TEXT = ["eudract_nr", "nct_id", "Protocol", "Sponsor", "Sponsor_type", "status", "study_type", "intervention_model", "primary_purpose",
         "expanded_access_nctid", "expanded_access_status_for_nctid", "baseline_population", "enrollment_type", "why_stopped", "start_month_year",
         "start_date_type", "completion_month_year", "completion_date_type", "intervention_model_description", "observational_model",
         "time_perspective", "url"]
PROGRAMME_BLANKS = {c: "VARCHAR" if c in _TEXT else "INTEGER" if c.startswith("number_of") else "BOOLEAN"
                    for c in MERGED_COLUMNS if c not in ("title", "enrollment", "source_dataset")}


def shown_sql(plain: list[str], days: list[str] = (), lists: list[str] = ()) -> str:
    return ", ".join([*[f'"{c}"' for c in plain], *[f"strftime({c}, '%Y-%m-%d') AS {c}" for c in days],
                      *[f"array_to_string(list_transform({c}, lambda x: coalesce(x, 'null')), '|') AS {c}" for c in lists]])


def shown(df: DataFrame, plain: list[str], days: list[str] = (), lists: list[str] = ()) -> DataFrame:
    return df.select(*plain, *[day(F.col(c)).alias(c) for c in days], *[F.array_join(c, "|", "null").alias(c) for c in lists])


# --- queries --------------------------------------------------------------------------

EXTRACT_PLAIN = ["nct_id", "eudract_id", "official_title", "acronym", "phase", "study_type", "overall_status", "source", "source_class",
                 "enrollment", "number_of_arms", "has_expanded_access", "allocation", "intervention_model", "primary_purpose", "masking",
                 "masking_description", "minimum_age_num", "minimum_age_unit", "maximum_age_num", "maximum_age_unit", *CARRIED]
EXTRACT_DAYS = ["study_first_submitted_date", "start_date", "completion_date"]
EXTRACT_LISTS = ["terms", "grouping", "condition", "gender", "criteria", "keys", "interv"]


@query(f"WITH {EXTRACT} SELECT {shown_sql(EXTRACT_PLAIN, EXTRACT_DAYS, EXTRACT_LISTS)} FROM wide")
def registry_extract(t):
    return shown(extract(t), EXTRACT_PLAIN, EXTRACT_DAYS, EXTRACT_LISTS)


@query(f"WITH {EXTRACT} SELECT {shown_sql(EXTRACT_PLAIN, EXTRACT_DAYS, EXTRACT_LISTS)} FROM wide")
def registry_extract_one_row(t):
    """Every study has one row in each table here, so one row per study is all of them."""
    return shown(extract(t, one_row=True), EXTRACT_PLAIN, EXTRACT_DAYS, EXTRACT_LISTS)


def bucketed_tables(t, buckets: int = 8) -> dict[str, DataFrame]:
    return landing.land_together({n: r.frame(t) for n, r in REGISTRY.items()}, "nct_id", t.scratch("bucketed"), buckets)


@query(f"WITH {EXTRACT} SELECT {shown_sql(EXTRACT_PLAIN, EXTRACT_DAYS, EXTRACT_LISTS)} FROM wide")
def registry_extract_bucketed(t):
    """The extract over tables that were landed bucketed by study."""
    found = registry.registry_extract(bucketed_tables(t), COUNTRY, ordered=False)
    return shown(found, EXTRACT_PLAIN, EXTRACT_DAYS, EXTRACT_LISTS)


@query(f"""
WITH {HARMONISED} SELECT eudract_nr, title, sponsor AS "Sponsor", sponsor_type AS "Sponsor_type", status, nr_enrolled,
  strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, minor AS "Age_0_17_years",
  adult AS "Age_18_64_years", elderly AS "Age_65p_years", female AS "Gender_F", male AS "Gender_M", controlled AS "trial_design_Controlled",
  randomised AS "trial_design_Randomised", dose AS "trial_scope_Dose_response", p1 AS "trial_Phase_I", p2 AS "trial_Phase_II",
  p3 AS "trial_Phase_III", p4 AS "trial_Phase_IV", eu_arms FROM eu""")
def harmonise_sources(t):
    return shown(harmonised(t), [
        "eudract_nr", "title", "Sponsor", "Sponsor_type", "status", "nr_enrolled", "Age_0_17_years", "Age_18_64_years", "Age_65p_years",
        "Gender_F", "Gender_M", "trial_design_Controlled", "trial_design_Randomised", "trial_scope_Dose_response", "trial_Phase_I",
        "trial_Phase_II", "trial_Phase_III", "trial_Phase_IV", "eu_arms"], ["start_date", "end_date"])


@query(f"""
WITH {CLEAN} SELECT nct_id, eudract_nr, title, "Protocol", study_type, overall_status, source, source_class, enrollment, number_of_arms,
  has_expanded_access, intervention_model, primary_purpose, masking, masking_description, {", ".join(CARRIED)}, non_randomized AS "allocation_NON_RANDOMIZED", adaptive AS "allocation_ADAPTIVE",
  parallel AS "intervention_model_PARALLEL", crossover AS "intervention_model_CROSSOVER", factorial AS "intervention_model_FACTORIAL",
  sequential AS "intervention_model_SEQUENTIAL", mask_single AS "masking_SINGLE", mask_double AS "masking_DOUBLE", mask_triple AS "masking_TRIPLE",
  mask_quadruple AS "masking_QUADRUPLE", {shown_sql([], EXTRACT_DAYS, ["criteria", "keys", "interv"])}, terms, grouping, condition, p0 AS "trial_Early_Phase_I", p1 AS "trial_Phase_I",
  p2 AS "trial_Phase_II", p3 AS "trial_Phase_III", p4 AS "trial_Phase_IV", randomized AS "allocation_RANDOMIZED",
  single_group AS "intervention_model_SINGLE_GROUP", mask_none AS "masking_NONE", female AS "Gender_FEMALE", male AS "Gender_MALE",
  round(low, 6) AS minimum_age_num, round(high, 6) AS maximum_age_num FROM clean""")
def clean_registry(t):
    """The code knows no allocation called ADAPTIVE; the tables do."""
    df = registry.spread_categories(registry.clean_registry(extract(t, ordered=False)))
    return df.select("nct_id", "eudract_nr", "title", "Protocol", "study_type", "overall_status", "source", "source_class", "enrollment",
                     "number_of_arms", "has_expanded_access", "intervention_model", "primary_purpose", "masking", "masking_description", *CARRIED,
                     "allocation_NON_RANDOMIZED", "allocation_ADAPTIVE", "intervention_model_PARALLEL", "intervention_model_CROSSOVER",
                     "intervention_model_FACTORIAL", "intervention_model_SEQUENTIAL", "masking_SINGLE", "masking_DOUBLE", "masking_TRIPLE",
                     "masking_QUADRUPLE", *[day(F.col(c)).alias(c) for c in EXTRACT_DAYS],
                     *[F.array_join(c, "|", "null").alias(c) for c in ("criteria", "keys", "interv")],
                     "terms", "grouping", "condition", "trial_Early_Phase_I", "trial_Phase_I",
                     "trial_Phase_II", "trial_Phase_III", "trial_Phase_IV", "allocation_RANDOMIZED",
                     "intervention_model_SINGLE_GROUP", "masking_NONE", "Gender_FEMALE", "Gender_MALE",
                     F.round("minimum_age_num", 6).alias("minimum_age_num"), F.round("maximum_age_num", 6).alias("maximum_age_num"))


@query(f"WITH {MERGED} SELECT {shown_sql([*MERGED_COLUMNS, 'allocation_ADAPTIVE'], MERGED_DAYS, MERGED_LISTS)} FROM merged")
def merge_registries(t):
    """With the one allocation that the code does not know."""
    whole = merged(t)
    unknown = F.when(F.col("other_categories").isNotNull(), F.map_contains_key("other_categories", "allocation_ADAPTIVE"))
    return shown(whole.withColumn("allocation_ADAPTIVE", unknown), [*MERGED_COLUMNS, "allocation_ADAPTIVE"], MERGED_DAYS, MERGED_LISTS)


@query(f"""
WITH {MERGED} SELECT 'allocation_ADAPTIVE' AS category, count(*) FILTER ("allocation_ADAPTIVE") AS studies, count(*) FILTER (NOT "allocation_ADAPTIVE") AS others,
  count(*) FILTER ("allocation_ADAPTIVE" IS NULL) AS unknown FROM merged""")
def open_categories(t):
    """Every category of the merged table that the code does not know, learned from its map column."""
    whole = merged(t)
    spread = registry.spread_categories(whole)
    found = [c for c in spread.columns if c not in whole.columns]
    counts = [F.struct(F.lit(c).alias("category"), F.count_if(c).alias("studies"), F.count_if(~F.col(c)).alias("others"),
                       F.count_if(F.col(c).isNull()).alias("unknown")) for c in found]
    return spread.agg(F.array(*counts).alias("x")).select(F.inline("x"))


@query(f"""
WITH p AS ({PROGRAMMES.sql()})
SELECT "Nome" AS title, strftime(try_strptime(data_decisao, '%d/%m/%Y'), '%Y-%m-%d') AS start_date,
  try_cast(string_split(n_doentes, '/')[1] AS DOUBLE) AS enrollment, "DCI" AS interventions, detalhes AS therapeutic_area,
  {", ".join(f'NULL::{t} AS "{c}"' for c, t in PROGRAMME_BLANKS.items())}, 'PAP Infarmed' AS source_dataset FROM p""")
def align_programmes(t):
    aligned = merge.align_programmes(programmes(t), merged(t).schema)
    return shown(aligned, ["title", "enrollment", "source_dataset", *PROGRAMME_BLANKS], ["start_date"], ["interventions", "therapeutic_area"])


@query("""
WITH l AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus, c_custkey, c_acctbal, c_mktsegment FROM l JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > 0 AND o_orderstatus IS NOT NULL AND c_acctbal > 0 AND c_mktsegment IS NOT NULL""")
def two_source_etl(t):
    left = two_sources.Source(t.orders, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], "o_totalprice", "o_orderstatus",
                              ["o_orderpriority", "o_none"])
    right = two_sources.Source(t.customer, "c_custkey", [F.col("c_name")], "c_acctbal", "c_mktsegment", ["c_nationkey"])
    return two_sources.join_two_sources(left, right).drop("o_orderdate", "c_name")


def counted(section: str, label: str, source: str = "merged", limit: int | None = None) -> str:
    top = f" ORDER BY total DESC, label LIMIT {limit}" if limit else ""
    return f"SELECT * FROM (SELECT '{section}' AS section, ({label})::VARCHAR AS label, count(*) AS total FROM {source} GROUP BY 2 HAVING label IS NOT NULL{top})"


def flagged(section: str, label: str, condition: str, source: str = "merged") -> str:
    return f"SELECT '{section}' AS section, '{label}' AS label, count(*) FILTER ({condition}) AS total FROM {source}"


def unnested(column: str) -> str:
    return f"(SELECT unnest({column}) AS item FROM merged)"


OVERVIEW = " UNION ALL ".join([
    flagged("kpi", "studies", "true"), "SELECT 'kpi', 'participants', sum(enrollment)::BIGINT FROM merged",
    flagged("kpi", "recruiting", "status ILIKE '%recruiting%'"), flagged("kpi", "expanded access", "has_expanded_access"),
    flagged("participation", "Female", '"Gender_F"'), flagged("participation", "Male", '"Gender_M"'),
    flagged("participation", "Children (0-17)", '"Age_0_17_years"'),
    *[flagged("phase", n, f'"{c}"') for n, c in {"Early I": "trial_Early_Phase_I", "I": "trial_Phase_I", "II": "trial_Phase_II",
                                                 "III": "trial_Phase_III", "IV": "trial_Phase_IV"}.items()],
    *[flagged("masking", n, f'"masking_{c}"') for n, c in {"Open": "OPEN", "Single-blind": "SINGLE", "Double-blind": "DOUBLE"}.items()],
    counted("year", "year(study_first_submitted_date)"), counted("study type", "study_type"),
    counted("intervention model", "intervention_model"), counted("sponsor type", '"Sponsor_type"', limit=10),
    counted("criteria", "CASE WHEN inclusion_crt IS NOT NULL OR exclusion_crt IS NOT NULL THEN 'Has criteria' ELSE 'No criteria' END"),
    counted("area", "item", unnested("therapeutic_area"), 30), counted("keyword", "item", unnested("keywords"), 10),
])


@query(f"WITH {MERGED} {OVERVIEW}")
def overview_kpis(t):
    return reports.overview(merged(t))


@query(f"WITH {MERGED} SELECT year(start_date)::INTEGER AS start_year, enrollment FROM merged WHERE start_date IS NOT NULL AND enrollment IS NOT NULL")
def enrolment_by_year(t):
    return reports.enrolment_by_year(merged(t))


CHOSEN = """chosen AS (SELECT * FROM merged WHERE lower(study_type) IN ('interventional') AND len(list_intersect(therapeutic_area, ['asthma', 'red bolt'])) > 0
  AND len(list_filter(interventions, lambda x: lower(x) IN ('drug 1', 'drug 2', 'drug 3', 'drug 4', 'drug 5', 'drug 6', 'drug 7'))) > 0)"""


def chosen(t) -> DataFrame:
    return reports.filter_studies(merged(t), ["Interventional"], ["Asthma ", "red bolt"], [f"Drug {i}" for i in range(1, 8)])


@query(f"WITH {MERGED}, {CHOSEN} " + OVERVIEW.replace("FROM merged", "FROM chosen"))
def overview_filtered(t):
    return reports.overview(chosen(t))


@query(f"WITH {MERGED} " + OVERVIEW.replace(" ORDER BY total DESC, label LIMIT 30", "").replace(" ORDER BY total DESC, label LIMIT 10", ""))
def overview_whole(t):
    """All labels of every section."""
    return reports.overview(merged(t), sizes=None)


@query(f"""
WITH {MERGED} SELECT title, strftime(start_date, '%Y-%m-%d') AS start_date, source_dataset, array_to_string(therapeutic_area, ', ') AS therapeutic_area,
  enrollment FROM merged""")
def overview_export(t):
    path = t.scratch("overview")
    files.write_csv(reports.export_table(merged(t), "eudract_nr", "nct_id"), path)
    return files.read_csv(t.spark, path, "title string, start_date string, source_dataset string, therapeutic_area string, enrollment double")


@query(f"""
WITH {MERGED} SELECT title, strftime(start_date, '%Y-%m-%d') AS start_date, array_to_string(therapeutic_area, ', ') AS therapeutic_area,
  array_to_string(interventions, ', ') AS interventions, study_type, status FROM merged WHERE "Gender_F" AND status ILIKE '%complet%'""")
def search_export(t):
    path = t.scratch("search")
    found = search.faceted_search(merged(t), sex="Female", status="complet")
    files.write_csv(search.details(found, "title"), path)
    return files.read_csv(t.spark, path, "title string, start_date string, therapeutic_area string, interventions string, study_type string, status string")


PROGRAMME_ROWS = f"""rows AS (SELECT *, try_strptime(data_decisao, '%d/%m/%Y') AS decided FROM ({PROGRAMMES.sql()}) WHERE decisao IS NOT NULL),
active AS (SELECT * FROM rows WHERE decided IS NOT NULL AND cond_observ LIKE '%PAP ativo%')"""


@query(f"WITH {PROGRAMME_ROWS} " + " UNION ALL ".join([
    flagged("kpi", "programmes", "true", "active"), flagged("kpi", "decided", "decisao IS NOT NULL", "active"),
    flagged("kpi", "approved", "decisao = 'Deferido'", "active"), flagged("kpi", "active", "cond_observ LIKE '%PAP ativo%'", "active"),
    flagged("kpi", "with costs", "cond_observ LIKE '%com custos%'", "active"), counted("year", "year(decided)", "active"),
    counted("decision", "decisao", "active"), counted("substance", '"DCI"', "active", 10)]))
def programme_report(t):
    df = programmes(t).withColumn("data_decisao", to_day(F.col("data_decisao"), "dd/MM/yyyy"))
    return reports.programme_report(reports.filter_programmes(df, active=True))


def dated_programmes(t) -> DataFrame:
    return programmes(t).withColumn("data_decisao", to_day(F.col("data_decisao"), "dd/MM/yyyy"))


@query(f"WITH {PROGRAMME_ROWS} SELECT count(*) FILTER (decisao = 'Deferido') / count(*) AS share FROM rows WHERE decided IS NOT NULL")
def programme_share(t):
    return reports.approved_share(reports.programme_report(reports.filter_programmes(dated_programmes(t))))


@query(f"""
WITH {PROGRAMME_ROWS}, y AS (SELECT max(year(decided)) AS top FROM rows)
SELECT "Nome", decisao, year(decided)::INTEGER AS decided FROM rows, y WHERE year(decided) = top AND decisao IN ('Deferido', 'Indeferido')
  AND cond_observ LIKE '%com custos%'""")
def programme_filters(t):
    df = dated_programmes(t)
    last = df.agg(F.max(F.year("data_decisao"))).first()[0]
    found = reports.filter_programmes(df, [last], ["Deferido", "Indeferido"], with_costs=True)
    return found.select("Nome", "decisao", F.year("data_decisao").alias("decided"))


@query(f"""
WITH {PROGRAMME_ROWS} SELECT "Nome", "DCI", decisao, strftime(decided, '%Y-%m-%d') AS data_decisao, try_cast(string_split(n_doentes, '/')[1] AS DOUBLE) AS n_doentes,
  cond_observ LIKE '%PAP ativo%' AS "PAP_act", CASE WHEN cond_observ LIKE '%com custos%' THEN true WHEN cond_observ LIKE '%sem custos%' THEN false END AS c_custos
FROM (SELECT * REPLACE (coalesce(cond_observ, '') AS cond_observ) FROM rows) WHERE decided IS NOT NULL""")
def programme_table(t):
    path = t.scratch("programmes")
    files.write_csv(reports.programme_table(reports.filter_programmes(dated_programmes(t)), "Nome"), path)
    return files.read_csv(t.spark, path, "Nome string, DCI string, decisao string, data_decisao string, n_doentes double, PAP_act boolean, c_custos boolean")


WORDS = ["the", "que", "und", "erin", "with", "para", "des"]


def hits(shown_text: str) -> str:
    return "(" + " + ".join(f"contains({shown_text}, '{w}')::INTEGER" for w in WORDS) + f") / {len(WORDS)}"


SHORTLIST = rf"""
WITH d AS (SELECT doc_id, lang, source, n_chars, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS title FROM documents),
o AS (SELECT *, row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id) - 1 AS ordinal, count(*) OVER () AS n FROM d),
first AS (SELECT * FROM o WHERE ordinal // 100 < ceil(ceil(n / 100) * 0.5) AND {hits("lower('Title: ' || title)")} > 0.5)
SELECT doc_id AS database_index, round({hits("lower('Title: ' || title || ', Language: ' || lang || ', Source: ' || source)")}, 9) AS certainty,
  title AS "Title" FROM first ORDER BY certainty DESC, doc_id LIMIT 5"""


def shortlisted(t, scorer, store: str | None = None) -> DataFrame:
    studies = t.documents.select("doc_id", text.normalise(F.col("text")).alias("title"), "n_chars", "lang", "source")
    best = short.shortlist(
        studies, "doc_id", "title", "n_chars",
        [("Title", F.col("title")), ("Language", F.col("lang")), ("Source", F.col("source"))],
        scorer, size=100, proportion=0.5, cutoff=0.5, store=store)
    return best.withColumn("certainty", F.round("certainty", 9))


@query(SHORTLIST)
def shortlist(t):
    return shortlisted(t, short.keyword_scorer(WORDS))


@query(SHORTLIST)
def shortlist_stored(t):
    """The second run finds every answer in the store: its scorer knows nothing."""
    store = t.scratch("answers")
    shortlisted(t, short.keyword_scorer(WORDS), store)
    return shortlisted(t, short.keyword_scorer(["nothing"]), store)


@query("""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id) - 1 AS ordinal FROM documents)
SELECT count(DISTINCT ordinal // 50) FILTER ((ordinal // 50) % 2 = 1) AS bad_answers FROM o""")
def bad_answer_count(t):
    """Every other chunk gets an answer without a list; counted from the rows of the one pass."""
    def unreadable(batches):
        for b in batches:
            yield b[["chunk"]].assign(answer=["no list" if c % 2 else "```json\n[]\n```" for c in b["chunk"]])

    chunks = ordering.chunk_rows(t.documents.select("doc_id", "n_chars"), [F.desc_nulls_last("n_chars"), F.col("doc_id")], 50)
    contexts = ordering.chunk_context(chunks, text.labelled_line([("id", F.col("doc_id"))]), "Studies:")
    return short.bad_answers(short.ask(contexts, unreadable))


FACET_ROWS = """flags AS (SELECT l_orderkey, list(DISTINCT lower(l_returnflag)) AS flags FROM lineitem GROUP BY 1),
studies AS (SELECT o_orderkey, nullif(lower(o_orderstatus), 'p') AS status, lower(o_orderpriority) AS priority, flags FROM orders LEFT JOIN flags ON l_orderkey = o_orderkey),
entries AS (SELECT o_orderkey, 'status' AS facet, status AS option FROM studies WHERE status IS NOT NULL UNION ALL SELECT o_orderkey, 'priority', priority FROM studies
  UNION ALL SELECT o_orderkey, 'flag', unnest(flags) FROM studies),
chosen AS (SELECT o_orderkey FROM studies WHERE status IN ('f', 'o') AND list_contains(flags, 'r'))"""


def facet_studies(t) -> tuple[DataFrame, DataFrame]:
    """Orders as numbered studies with three facets, and their index; a status is missing for one in many."""
    flags = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_returnflag").alias("flags"))
    rows = facets.numbered(t.orders.join(flags, "o_orderkey", "left").select("o_orderkey", "o_orderstatus", "o_orderpriority", "flags"), [F.col("o_orderkey")])
    status = F.nullif("o_orderstatus", F.lit("P"))
    return rows, facets.facet_index(rows, {"status": facets.options_of(status, False), "priority": facets.options_of(F.col("o_orderpriority"), False),
                                           "flag": facets.options_of(F.col("flags"))})


FACET_CHOICE = {"status": ["f", "o"], "flag": ["r"]}


@query(f"""WITH {FACET_ROWS}, o AS (SELECT DISTINCT facet, option FROM entries)
SELECT facet, option, (SELECT count(*) FROM entries e WHERE e.facet = o.facet AND e.option = o.option AND e.o_orderkey IN (SELECT o_orderkey FROM chosen)) AS studies FROM o""")
def facet_counts(t):
    return facets.facet_counts(facet_studies(t)[1], FACET_CHOICE)


@query(f"WITH {FACET_ROWS} SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM chosen)")
def facet_rows(t):
    rows, index = facet_studies(t)
    return facets.rows_of(rows, facets.chosen_studies(index, FACET_CHOICE)).select("o_orderkey", "o_orderstatus", "o_orderpriority")
