"""Driver tables in the shape of the raw trial sources.

Each raw frame is one table plus column expressions valid in Spark and in DuckDB, so
both sides start from the same values. Orders stand for studies, their customers'
nations for countries, lines and parts for the lists, events for programmes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Raw:
    source: str
    columns: dict[str, str]
    where: str | None = None
    links: tuple[tuple[str, str], ...] = ()

    def frame(self, t) -> DataFrame:
        df = reduce(lambda d, link: d.join(getattr(t, link[0]), _condition(link[1])), self.links, getattr(t, self.source))
        df = df.where(self.where) if self.where else df
        return df.selectExpr(*[f"{e} AS `{n}`" for n, e in self.columns.items()])

    def sql(self) -> str:
        joins = "".join(f" JOIN {table} ON {condition}" for table, condition in self.links)
        where = f" WHERE {self.where}" if self.where else ""
        chosen = ", ".join(f'{e} AS "{n}"' for n, e in self.columns.items())
        return f"SELECT {chosen} FROM {self.source}{joins}{where}"


def _condition(text: str):
    from pyspark.sql import functions as F
    return F.expr(text)


NCT = "concat('NCT', lpad(concat(o_orderkey), 8, '0'))"
LINE_NCT = "concat('NCT', lpad(concat(l_orderkey), 8, '0'))"
EU_NUMBER = "concat(year(o_orderdate), '-', lpad(concat(o_orderkey % 1000000), 6, '0'), '-', lpad(concat(o_custkey % 100), 2, '0'))"


def by(column: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {column} {whens} END"


URGENT, HIGH, MEDIUM, SOME, LOW = "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"

REGISTRY = {
    "studies": Raw("orders", {
        "nct_id": NCT,
        "official_title": "concat('Study ', o_orderkey, ' for ', o_custkey)",
        "acronym": "CASE WHEN o_orderstatus = 'F' THEN concat('AC', o_custkey) END",
        "phase": by("o_orderpriority", {URGENT: "PHASE1", HIGH: "PHASE1/PHASE2", MEDIUM: "PHASE2/PHASE3", SOME: "EARLY_PHASE1"}),
        "study_type": by("o_orderstatus", {"F": "INTERVENTIONAL", "O": "OBSERVATIONAL"}),
        "overall_status": by("o_orderstatus", {"F": "COMPLETED", "O": "RECRUITING", "P": "WITHDRAWN"}),
        "source": "concat('Clinic ', o_custkey % 40)",
        "source_class": by("o_orderpriority", {URGENT: "INDUSTRY", HIGH: "OTHER", MEDIUM: "NIH", LOW: "OTHER"}),
        "enrollment": "CASE WHEN o_totalprice > 100000 THEN CAST(floor(o_totalprice / 1000) AS INT) END",
        "number_of_arms": "CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey % 5 + 1 AS INT) END",
        "study_first_submitted_date": "CAST(o_orderdate AS DATE)",
        "start_date": "CAST(o_orderdate AS DATE) + 30",
        "completion_date": "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 365 END",
        "has_expanded_access": "CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus = 'P' END",
        "baseline_population": "CASE WHEN o_orderstatus = 'F' THEN concat('adults of ', o_custkey % 7) END",
        "enrollment_type": by("o_orderstatus", {"F": "ACTUAL", "O": "ESTIMATED"}),
        "number_of_groups": "CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey % 3 + 1 AS INT) END",
        "why_stopped": "CASE WHEN o_orderstatus = 'P' THEN concat('reason ', o_custkey % 4) END",
        "start_month_year": "substr(concat(o_orderdate), 1, 7)",
        "start_date_type": by("o_orderstatus", {"F": "ACTUAL", "O": "ESTIMATED"}),
        "completion_month_year": "CASE WHEN o_orderstatus <> 'P' THEN substr(concat(o_orderdate), 1, 7) END",
        "completion_date_type": by("o_orderstatus", {"F": "ACTUAL"}),
        "expanded_access_nctid": "CASE WHEN o_orderstatus = 'P' THEN concat('NCT', o_custkey) END",
        "expanded_access_status_for_nctid": by("o_orderstatus", {"P": "AVAILABLE"}),
        "expanded_access_type_individual": "o_orderstatus = 'P'",
        "expanded_access_type_intermediate": "CASE WHEN o_orderstatus = 'P' THEN o_custkey % 2 = 0 END",
        "expanded_access_type_treatment": "CASE WHEN o_orderstatus = 'P' THEN o_custkey % 3 = 0 END",
    }),
    "countries": Raw("orders", {"nct_id": NCT, "name": "n_name", "removed": "c_acctbal < 0"},
                     links=(("customer", "o_custkey = c_custkey"), ("nation", "c_nationkey = n_nationkey"))),
    "id_information": Raw("orders", {
        "nct_id": NCT,
        "id_value": f"CASE o_orderstatus WHEN 'F' THEN {EU_NUMBER} WHEN 'P' THEN concat('ISRCTN', o_orderkey) END"}),
    "search_term_results": Raw("lineitem", {"nct_id": LINE_NCT, "search_term_id": "l_partkey"}),
    "search_terms": Raw("part", {"id": "p_partkey", "term": "p_name", "group": "p_type"}),
    "designs": Raw("orders", {
        "nct_id": NCT,
        "allocation": by("o_orderstatus", {"F": "RANDOMIZED", "O": "NON_RANDOMIZED", "P": "ADAPTIVE"}),
        "intervention_model": by("o_orderpriority", {URGENT: "PARALLEL", HIGH: "CROSSOVER", MEDIUM: "SINGLE_GROUP", SOME: "FACTORIAL", LOW: "SEQUENTIAL"}),
        "primary_purpose": by("o_orderpriority", {URGENT: "TREATMENT", HIGH: "PREVENTION", LOW: "SCREENING"}),
        "masking": by("o_orderpriority", {URGENT: "NONE", HIGH: "SINGLE", MEDIUM: "DOUBLE", SOME: "QUADRUPLE", LOW: "TRIPLE"}),
        "masking_description": "CASE WHEN o_orderstatus = 'F' THEN 'sealed' END",
        "intervention_model_description": "CASE WHEN o_orderstatus = 'F' THEN concat('arm ', o_custkey % 3) END",
        "observational_model": by("o_orderstatus", {"O": "COHORT"}),
        "time_perspective": by("o_orderstatus", {"O": "PROSPECTIVE"}),
        "subject_masked": "o_orderpriority = '2-HIGH'",
        "caregiver_masked": "o_orderpriority = '3-MEDIUM'",
        "investigator_masked": "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority = '3-MEDIUM' END",
        "outcomes_assessor_masked": "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority = '4-NOT SPECIFIED' END"}),
    "conditions": Raw("lineitem", {
        "nct_id": LINE_NCT, "name": by("l_returnflag", {"A": "Asthma (adult)", "N": "Neoplasms"})}),
    "calculated_values": Raw("orders", {
        "nct_id": NCT,
        "minimum_age_num": "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 80 AS INT) END",
        "minimum_age_unit": by("o_orderpriority", {URGENT: "Years", HIGH: "Months", MEDIUM: "Days", SOME: "Years", LOW: "Weeks"}),
        "maximum_age_num": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 80 + 30 AS INT) END",
        "maximum_age_unit": by("o_orderstatus", {"F": "Years"})}),
    "eligibilities": Raw("orders", {
        "nct_id": NCT,
        "gender": by("o_orderpriority", {URGENT: "ALL", HIGH: "FEMALE", MEDIUM: "MALE", LOW: "ALL"}),
        "criteria": "CASE WHEN o_orderstatus <> 'P' THEN concat('Inclusion Criteria: adult of ', o_custkey % 80, "
                    "'; able to consent 2. written form* Exclusion Criteria: 1. pregnancy 2. age >= ', o_custkey % 90) "
                    "ELSE 'See protocol' END"}),
    "keywords": Raw("lineitem", {"nct_id": LINE_NCT, "name": "concat('word ', l_linenumber)"}),
    "interventions": Raw("lineitem", {"nct_id": LINE_NCT, "name": "concat('Drug ', l_suppkey)"}),
}

NUMBER = f"CASE WHEN o_orderstatus <> 'P' THEN {EU_NUMBER} END"
EU_SHARED = {
    "eudract_nr": NUMBER,
    "title": "concat('Trial ', o_orderkey)",
    "Protocol": "CASE WHEN o_orderpriority <> '5-LOW' THEN concat('P-', o_custkey) END",
    "url": "concat('https://register.example/', o_orderkey)",
}
EU = {
    "older": Raw("orders", {
        **EU_SHARED,
        "Sponsor": "concat('Sponsor ', o_custkey % 60, ', Sponsor ', o_custkey % 60)",
        "status": by("o_orderstatus", {"F": "Completed", "O": "Ongoing"}),
        "start_date": "substr(concat(o_orderdate), 1, 10)",
        "end_date": "CASE WHEN o_orderstatus = 'F' THEN '2001-02-30' WHEN o_orderstatus = 'O' THEN '2003-12-31' END",
        "trial_design": "concat('{\"Controlled\": \"', CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END, "
                        "'\", \"Randomised\": \"', CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN 'Not known' ELSE '0' END, "
                        "'\", \"Open\": \"1\", \"Parallel group\": \"0\", \"Number of treatment arms in the trial\": \"', o_custkey % 7, '\"}')",
        "trial_scope": "CASE WHEN o_orderstatus <> 'P' THEN '{\"Therapy\": \"1\", \"Dose response\": \"0\"}' END",
        "trial_phase": "concat('{\"Human pharmacology (Phase I)\": \"', o_custkey % 2, '\", \"Therapeutic use (Phase IV)\": \"', o_orderkey % 2, '\"}')",
        "Age_Trial_has_subjects_under_18": "CASE WHEN o_orderpriority <> '2-HIGH' THEN concat(o_custkey % 2) END",
        "Age_Adolescents_(12-17_years)": "'1'",
        "Age_Adults_(18-64_years)": "concat(o_orderkey % 2)",
        "Gender_F": "'1'",
        "Gender_M": "CASE WHEN o_orderstatus = 'F' THEN '0' END",
        "therapeutic_area": "concat('Diseases [C] - Area ', o_custkey % 12, ' [C04]')",
        "condition": "concat('[\"Condition ', o_custkey % 9, '\", \"Fever\"]')",
        "inclusion_crt": "CASE WHEN o_orderpriority <> '3-MEDIUM' THEN '[\"age over 18\", \"consent\"]' END",
        "exclusion_crt": "CASE WHEN o_orderpriority = '1-URGENT' THEN '[\"pregnancy\"]' END",
    }, where="o_totalprice > 250000"),
    "newer": Raw("orders", {
        **EU_SHARED,
        "Sponsor": "concat('Sponsor ', o_custkey % 60)",
        "Sponsor_type": by("o_orderpriority", {URGENT: "Industry, Industry", HIGH: "Industry, Academia", MEDIUM: "Academia"}),
        "status": by("o_orderstatus", {"F": "Ended", "O": "Ongoing, recruiting"}),
        "start_date": "CASE WHEN o_orderstatus <> 'O' THEN substr(concat(o_orderdate), 1, 10) ELSE '2020/01/01' END",
        "trial_phase_desc": by("o_orderpriority", {URGENT: "Phase I and Phase II", HIGH: "Phase III", MEDIUM: "Therapeutic use (Phase IV)"}),
        "Age": by("o_orderpriority", {URGENT: "0-17 years, 18-64 years", HIGH: "18-64 years, 65+ years", MEDIUM: "65+ years"}),
        "Gender": by("o_orderstatus", {"F": "Female, Male", "O": "Female"}),
        "nr_enrolled": "CASE WHEN o_orderpriority <> '5-LOW' THEN concat(o_custkey) ELSE 'n/a' END",
        "therapeutic_area": "concat('[\"Diseases [C] - Area ', o_custkey % 12, ' [C05]\", \"Virus\"]')",
        "condition": "concat('Condition ', o_custkey % 9, ', Cough')",
        "inclusion_crt": "'[\"signed consent\"]'",
    }, where="o_totalprice <= 250000"),
}

PROGRAMMES = Raw("events", {
    "Nome": "concat('Programme ', event_id)",
    "DCI": "concat('substance ', user_id % 30)",
    "decisao": by("event_type", {"view": "Deferido", "click": "Indeferido", "signup": "Deferido", "purchase": "Em análise"}),
    "data_decisao": "CASE WHEN event_type = 'error' THEN '31/02/2024' ELSE concat(substr(concat(ts), 9, 2), '/', substr(concat(ts), 6, 2), '/', "
                    "substr(concat(ts), 1, 4)) END",
    "detalhes": "props",
    "n_doentes": "CASE event_type WHEN 'view' THEN concat(user_id, '/', event_id % 5) WHEN 'click' THEN concat(user_id) ELSE '-' END",
    "cond_observ": "CASE event_type WHEN 'view' THEN 'PAP ativo com custos' WHEN 'click' THEN 'PAP ativo sem custos' WHEN 'signup' THEN 'encerrado' END",
})


def ctes(raws: dict[str, Raw]) -> str:
    return ",\n".join(f"{name} AS ({raw.sql()})" for name, raw in raws.items())
