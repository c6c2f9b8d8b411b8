import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as book
import query_book
from query_book import reports as report_queries
from trialweave.plans import eu, facets, merge, registry, reports, search, shortlist as short

DATA = "/root/testdata/sf0.001"
D = datetime.date


@pytest.fixture(scope="module")
def tables(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)
    return {
        "studies": frame([("N1", "T1", "PHASE1/PHASE2", "COMPLETED", 10, D(2020, 1, 1)), ("N2", "T2", None, "RECRUITING", None, None),
                          ("N3", "T3", "PHASE4", "X", 5, D(2021, 1, 1))],
                         "nct_id string, official_title string, phase string, overall_status string, enrollment int, study_first_submitted_date date"),
        "countries": frame([("N1", "Portugal", False), ("N1", "Spain", False), ("N2", "Portugal", False), ("N3", "Portugal", True)],
                           "nct_id string, name string, removed boolean"),
        "id_information": frame([("N1", "2010-123456-12"), ("N1", "2011-000000-00"), ("N1", "ABC"), ("N2", None)], "nct_id string, id_value string"),
        "search_term_results": frame([("N1", 1), ("N1", 1), ("N1", 2)], "nct_id string, search_term_id int"),
        "search_terms": frame([(1, "lung", "chest"), (2, "heart", "chest")], "id int, term string, group string"),
        "designs": frame([("N1", "RANDOMIZED", "PARALLEL", "DOUBLE")], "nct_id string, allocation string, intervention_model string, masking string"),
        "conditions": frame([("N1", "Asthma"), ("N1", None), ("N2", None)], "nct_id string, name string"),
        "calculated_values": frame([("N1", 6, "Months", 17, "Years")],
                                   "nct_id string, minimum_age_num int, minimum_age_unit string, maximum_age_num int, maximum_age_unit string"),
        "eligibilities": frame([("N1", "ALL", "Inclusion Criteria: a\nExclusion Criteria: b")], "nct_id string, gender string, criteria string"),
        "keywords": frame([("N1", "k")], "nct_id string, name string"),
        "interventions": frame([("N2", "drug")], "nct_id string, name string"),
    }


def test_extract_repeats_a_study_per_matching_number_unless_asked(tables):
    df = registry.registry_extract(tables, "Portugal")
    assert [(r["nct_id"], r["eudract_id"]) for r in df.collect()][-1] == ("N2", None)
    assert sorted(r["nct_id"] for r in df.collect()) == ["N1", "N1", "N2"]
    one = registry.registry_extract(tables, "Portugal", one_row=True).where("nct_id = 'N1'").collect()
    assert len(one) == 1 and one[0]["eudract_id"] == "2010-123456-12"
    assert one[0]["terms"] == ["heart", "lung"] and one[0]["grouping"] == ["chest"] and one[0]["condition"] == ["Asthma"]


def test_clean_registry(tables):
    rows = {r["nct_id"]: r for r in registry.clean_registry(registry.registry_extract(tables, "Portugal", one_row=True)).collect()}
    a, b = rows["N1"], rows["N2"]
    assert a["trial_Phase_I"] and a["trial_Phase_II"] and not a["trial_Phase_III"] and a["Gender_FEMALE"] and a["Gender_MALE"]
    assert (a["minimum_age_num"], a["maximum_age_num"]) == (0.5, 17.0)
    assert b["trial_Phase_I"] is False and b["Gender_FEMALE"] is False and b["condition"] is None


OLD = [("2010-123456-12", "Old title", " Acme", '{"Randomised ": "0", "Number of treatment arms in the trial": "3"}',
        '{"Therapeutic use (Phase IV)": "1"}', "2019-05-05", "2025-02-30", '["crit"]', "1", '["Fever"]'),
       (None, "No number", "Solo", "broken", None, "bad", None, None, None, None)]
OLD_SCHEMA = ("eudract_nr string, title string, Sponsor string, trial_design string, trial_phase string, start_date string, "
              "end_date string, inclusion_crt string, `Age_Adults_(18-64_years)` string, condition string")
NEW = [("2022-1", "New", "Acme", "Industry, Industry", "Phase I and Phase II", "0-17 years", "Female", "x"),
       ("2022-2", "New2", "Acme", "Academia", None, None, None, "12"), (None,) * 8]
NEW_SCHEMA = "eudract_nr string, title string, Sponsor string, Sponsor_type string, trial_phase_desc string, Age string, Gender string, nr_enrolled string"


@pytest.fixture(scope="module")
def harmonised(spark):
    return eu.harmonise(spark.createDataFrame(OLD, OLD_SCHEMA), spark.createDataFrame(NEW, NEW_SCHEMA))


def test_harmonise(harmonised):
    rows = {r["title"]: r for r in harmonised.collect()}
    assert len(rows) == 4
    old, new, alone = rows["Old title"], rows["New"], rows["No number"]
    assert old["Sponsor"] == "Acme" and old["Sponsor_type"] == "Academia, Industry" and alone["Sponsor_type"] is None
    assert old["trial_design_Randomised"] is False and old["trial_Phase_IV"] and not old["trial_Phase_I"] and old["eu_arms"] == "3"
    assert old["start_date"] == D(2019, 5, 5) and old["end_date"] is None and old["Age_18_64_years"] is True
    assert new["trial_Phase_I"] and new["trial_Phase_II"] and not new["trial_Phase_III"] and new["Age_0_17_years"] and new["Gender_M"] is False
    assert alone["trial_Phase_I"] is False and alone["trial_design_Randomised"] is None


@pytest.fixture(scope="module")
def merged(harmonised, tables):
    return merge.merge_registries(harmonised, registry.clean_registry(registry.registry_extract(tables, "Portugal", one_row=True)))


def test_merge_precedence_and_keys(merged):
    rows = {r["title"]: r for r in merged.collect()}
    assert set(rows) == {"T1", "T2", "No number", "New", "New2"}  # null numbers match nothing
    both = rows["T1"]
    assert both["eudract_nr"] == "2010-123456-12" and both["Sponsor"] == "Acme" and both["source_dataset"] == "clinicaltrials.gov"
    assert both["trial_Phase_I"] and not both["trial_Phase_IV"] and both["trial_design_Randomised"] is False
    assert both["inclusion_crt"] == ["crit"] and both["exclusion_crt"] == ["b"] and both["number_of_arms"] == 3
    assert both["Age_0_17_years"] and not both["Age_18_64_years"] and both["masking_DOUBLE"] and both["enrollment"] == 10.0
    assert both["therapeutic_area"] == ["heart", "lung", "chest", "asthma"]
    assert rows["New"]["source_dataset"] == "clinicaltrials.eu" and rows["No number"]["source_dataset"] == "unknown"
    assert rows["New2"]["enrollment"] == 12.0 and rows["New"]["enrollment"] is None and rows["T2"]["interventions"] == ["drug"]


def test_programmes_take_the_merged_schema(spark, merged):
    raw = spark.createDataFrame([("P", "sub", "01/02/2020", "d", 7), ("Q", None, "31/02/2020", None, None)],
                                "Nome string, DCI string, data_decisao string, detalhes string, n_doentes long")
    df = merge.align_programmes(raw, merged.schema)
    assert df.columns == merged.columns
    assert [(r["title"], r["start_date"], r["enrollment"], r["source_dataset"]) for r in df.orderBy("title").collect()] == [
        ("P", D(2020, 2, 1), 7.0, "PAP Infarmed"), ("Q", None, None, "PAP Infarmed")]


def test_overview_and_search(merged):
    totals = {(r["section"], r["label"]): r["total"] for r in reports.overview(merged.withColumn("has_expanded_access", F.lit(None).cast("boolean"))
              .withColumn("study_type", F.lit("Interventional"))).collect()}
    assert totals["kpi", "studies"] == 5 and totals["kpi", "participants"] == 22 and totals["kpi", "recruiting"] == 1
    assert totals["kpi", "expanded access"] == 0 and totals["area", "chest"] == 1 and totals["study type", "Interventional"] == 5
    studies = merged.withColumn("study_type", F.lit("Interventional"))
    found = search.faceted_search(studies, condition="LUNG", age="0-17 years", outcome="x", status="complete")
    assert [r["title"] for r in search.details(found).collect()] == ["T1"]


def test_programme_report_and_share(spark):
    df = spark.createDataFrame([("a", "Deferido", True, None, D(2020, 1, 1)), ("a", "Indeferido", False, True, D(2021, 1, 1)),
                                ("b", None, True, True, None)], "DCI string, decisao string, PAP_act boolean, c_custos boolean, data_decisao date")
    assert reports.approved_share(reports.programme_report(df)).first()["share"] == 0.5
    assert reports.approved_share(reports.programme_report(df.where("false"))).first()["share"] == 0.0
    assert reports.filter_programmes(df).count() == 2 and reports.filter_programmes(df, years=[2020], active=True).count() == 1


def test_shortlist_finds_the_best_over_all_chunks(spark):
    df = spark.createDataFrame([(i, f"{'breast ' * (i % 2)}{'cancer' * (i % 3 == 0)} {i}", D(2020, 1, 1 + i % 20)) for i in range(60)],
                               "id long, title string, d date")
    best = short.shortlist(df, "id", "title", "d", [("Title", F.col("title"))], short.keyword_scorer(["breast", "cancer"]),
                           size=7, proportion=1.0)
    expected = [i for i in range(60) if i % 6 == 3][:5]
    assert sorted((r["database_index"], r["certainty"]) for r in best.collect()) == [(i, 1.0) for i in expected]

    def broken(batches):
        for b in batches:
            yield b[["chunk"]].assign(answer=["no list" if c else "```json\n[]\n```" for c in b["chunk"]])
    contexts = spark.createDataFrame([(0, "x"), (1, "y")], "chunk long, context string")
    assert short.bad_answers(short.ask(contexts, broken)).first()["bad_answers"] == 1


def test_every_query_has_sql_and_none_pairs_rows_without_a_key(spark):
    queries = query_book.QUERIES
    assert set(queries) == set(query_book.ORACLES) and len(queries) > 100
    assert set(queries) <= set(book.queries())
    for name in ("registry_extract", "merge_registries", "full_outer_coalesce", "full_outer_nullsafe", "chunk_rows", "describe_numeric",
                 "overview_kpis", "faceted_search", "source_inventory"):
        plan = queries[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_the_merge_computes_the_star_join_once(spark):
    def relations(name):
        plan = query_book.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Relation ["), plan.count("FullOuter")

    # One full outer join, above no more reads of the tables than its two sides have.
    (read, full), (left, _), (right, _) = [relations(n) for n in ("merge_registries", "harmonise_sources", "clean_registry")]
    assert full == 1 and read <= left + right


def test_chunks_move_no_table_for_their_offsets(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = query_book.QUERIES["chunk_rows"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = book.queries()["filter_isin"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan and "In(o_orderpriority" in plan.split("PushedFilters")[1]
    for name in ("normalise_terms", "extract_criteria", "to_list", "parse_scored_json"):
        plan = book.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan, name


def test_entry(spark):
    df = book.entry(spark)
    assert isinstance(df.schema, T.StructType) and df.count() > 0


def test_categories_nobody_knows_become_columns_without_a_list_of_names(spark):
    names = [*registry.DESIGN_COLUMNS, "phase", "gender", "terms", "grouping", "condition", *registry.AGE_COLUMNS, "eudract_id", "official_title", "acronym"]
    lists = {"gender", "terms", "grouping", "condition"}
    kinds = ", ".join(["nct_id string", *[f"{c} {'array<string>' if c in lists else 'string'}" for c in names]])
    def study(nct, **given):
        return tuple([nct, *[given.get(c) for c in names]])
    extract = spark.createDataFrame([study("N1", allocation="RANDOMIZED", masking="DOUBLE"), study("N2", allocation="ADAPTIVE", masking="QUINTUPLE"), study("N3")], kinds)
    clean = registry.clean_registry(extract)
    assert {r["nct_id"]: r["other_categories"] for r in clean.collect()} == {"N1": {}, "N2": {"allocation_ADAPTIVE": True, "masking_QUINTUPLE": True}, "N3": {}}
    wide = registry.spread_categories(clean)
    assert "other_categories" not in wide.columns and wide.columns[-2:] == ["allocation_ADAPTIVE", "masking_QUINTUPLE"]
    assert [tuple(r) for r in wide.orderBy("nct_id").select("allocation_ADAPTIVE", "masking_QUINTUPLE", "masking_DOUBLE").collect()] == [
        (False, False, True), (True, True, False), (False, False, False)]
    with pytest.raises(ValueError, match="more than 1"):
        registry.spread_categories(clean, limit=1)


def test_a_bucketed_landing_is_extracted_without_moving_its_tables(spark):
    t = query_book.Tables(spark, DATA)
    tables = report_queries.bucketed_tables(t, 4)
    wide = registry.registry_extract(tables, report_queries.COUNTRY, ordered=False)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan
    plain = registry.registry_extract({n: r.frame(t) for n, r in report_queries.REGISTRY.items()}, report_queries.COUNTRY, ordered=False)
    assert "Exchange hashpartitioning" in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, wide.collect())) == sorted(map(str, plain.collect()))


def test_facet_counts_and_rows_come_from_the_index(spark):
    rows = [(i, f" Area  {i % 3}", ["x", "Y ", "x"] if i % 2 else None) for i in range(40000)]
    studies = facets.numbered(spark.createDataFrame(rows, "id int, area string, keys array<string>").repartition(3), [F.col("id")])
    assert [r[0] for r in studies.agg(F.min("study_number"), F.max("study_number")).collect()] == [1]
    index = facets.facet_index(studies, {"area": facets.options_of(F.col("area"), False), "key": facets.options_of(F.col("keys"))})
    assert index.select("bucket").distinct().count() == 2

    def counts(choice):
        return {(r["facet"], r["option"]): r["studies"] for r in facets.facet_counts(index, choice).collect()}

    def brute(chosen):
        kept = [r for r in rows if chosen(r)]
        out = {("area", f"area {k}"): sum(r[0] % 3 == k for r in kept) for k in range(3)}
        return out | {("key", k): sum(r[2] is not None for r in kept) for k in ("x", "y")}

    assert counts({}) == brute(lambda r: True)
    assert counts({"area": ["area 0", "area 2"], "key": ["y"]}) == brute(lambda r: r[0] % 3 != 1 and r[0] % 2)
    assert counts({"area": ["none"]}) == brute(lambda r: False)
    found = facets.rows_of(studies, facets.chosen_studies(index, {"area": ["area 1"], "key": ["x", "y"]}))
    assert found.columns == studies.columns and {r["id"] for r in found.collect()} == {r[0] for r in rows if r[0] % 3 == 1 and r[0] % 2}
    empty = facets.facet_index(studies.limit(0), {"area": facets.options_of(F.col("area"), False)})
    assert facets.facet_counts(empty, {}).count() == 0


def test_a_scorer_is_asked_once_whatever_fails(spark, tmp_path):
    calls, store, broken = tmp_path / "calls", str(tmp_path / "answers"), tmp_path / "broken"
    calls.mkdir()
    broken.touch()

    def scorer(batches):
        import time
        import uuid

        for b in batches:
            for chunk in b["chunk"]:
                if chunk == 7 and broken.exists():
                    time.sleep(4)  # the others are done by then
                    raise RuntimeError("the service hung up")
                (calls / f"{chunk}-{uuid.uuid4().hex}").touch()
                yield b[b["chunk"] == chunk][["chunk"]].assign(answer=f"```json\n[{{\"database_index\": {chunk}, \"certainty\": 1}}]\n```")

    contexts = spark.createDataFrame([(i, f"context {i}") for i in range(12)] + [(90, "context 3")], "chunk long, context string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(Exception, match="hung up"):
            short.asked_once(contexts, scorer, store)
        first = len(list(calls.iterdir()))
        assert first >= 4 and short.stored_answers(spark, store).count() >= 4
        broken.unlink()
        answers = {r["chunk"]: r["answer"] for r in short.asked_once(contexts, scorer, store).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(answers) == {*range(12), 90} and answers[90] == answers[3]
    asked = [p.name.split("-")[0] for p in calls.iterdir()]
    assert len(asked) - len(set(asked)) <= first - 4 and sum(c in ("3", "90") for c in set(asked)) == 1
    before = len(asked)
    rows = short.ask(contexts, scorer, store)
    assert rows.count() == 13 and len(list(calls.iterdir())) == before
