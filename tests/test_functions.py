import datetime

from pyspark.sql import functions as F

from trialweave.functions import answers, lists, text
from trialweave.functions import values as v

C = lambda: F.col("c")


def test_to_number_rejects_java_suffixes_and_words(values):
    assert values(v.to_number(C()), ["1", " 2.5 ", "1e3", "1d", "x", "", None, "nan"]) == [1, 2.5, 1000, None, None, None, None, None]


def test_to_day_is_null_on_bad_dates(values):
    days = values(v.to_day(C(), "dd/MM/yyyy"), ["29/02/2020", "31/02/2020", "2020-01-01", None])
    assert days == [datetime.date(2020, 2, 29), None, None, None]


def test_flags(values):
    assert values(v.to_flag(C()), ["1", "0", "1.0", " 0 ", "2", "Yes", None]) == [True, False, True, False, None, None, None]
    assert values(v.to_flag(v.yes_no(C())), ["Yes", "No", "Not known"]) == [True, False, None]
    assert values(v.keyword_flag(C(), ["indefer"], ["defer"]), ["Deferido", "INDEFERIDO", "em curso", None]) == [True, False, None, None]


def test_strip_cuts_every_kind_of_space(values):
    assert values(v.strip(C()), ["  a b\t ", "\x1c", None]) == ["a b", "", None]
    assert values(text.normalise(C()), [" Á \n B  c "]) == ["á b c"]


def test_word_flags_do_not_match_longer_phases(values):
    seen = ["Phase I", "Phase II", "Phase I and Phase II", "Phase IV", None]
    assert values(v.holds(text.has_word(C(), "Phase I")), seen) == [True, False, True, False, False]


def test_split_ratio(values):
    number, rest = v.split_ratio(C())
    assert values(number, ["12/3", "12", "-", "a/b", None]) == [12, 12, None, None, None]
    assert values(rest, ["12/3", "12", "1/2/3"]) == ["3", None, "3"]


def test_age_bands_missing_bound_is_false(spark):
    df = spark.createDataFrame([(10, 15), (18, 64), (70, None), (None, None), (10, 30)], "lo int, hi int")
    bands = v.age_bands(F.col("lo"), F.col("hi"))
    rows = [tuple(r) for r in df.select(*bands.values()).collect()]
    assert rows == [(True, False, False), (False, True, False), (False, False, True), (False, False, False), (True, False, False)]
    wide = v.age_bands(F.col("lo"), F.col("hi"), overlap=True)
    assert [r[0] for r in df.select(wide["Age_18_64_years"]).collect()] == [False, True, False, False, True]


def test_to_list(values):
    seen = [None, "['a', 'b']", '["c, d"]', "x, ,y ", "['p', None, True]", "['None, x', 1]", "[broken"]
    assert values(lists.to_list(C()), seen) == [[], ["a", "b"], ["c, d"], ["x", "y"], ["p", None, "true"], ["None, x", "1"], ["[broken"]]


def test_ensure_list_and_unique_inside(values):
    assert values(lists.ensure_list(C()), [" a ", None]) == [["a"], None]
    assert values(lists.unique_inside(C()), ["b, a, b", None]) == ["b, a", None]
    assert values(lists.bracket_items(C()), ["['a', \"b\"]", "c"]) == [["a", "b"], ["c"]]


def test_tagged_round_trip_and_bad_json(values):
    kept = [["a", None, 'q"'], [], None]
    assert values(lists.tag_decode(lists.tag_encode(C())), kept, "array<string>") == kept
    assert values(lists.tag_decode(C()), ['__list__["a', "plain"]) == [['__list__["a'], ["plain"]]
    assert values(lists.tag_decode(C(), keep_bad=False), ['__list__["a']) == [None]


def test_json_maps(values):
    seen = ['{" A b ": "1", "A b": "2", "c": null}', "broken", None]
    assert values(lists.json_map(C()), seen) == [{"A_b": "2", "c": None}, None, None]
    assert values(lists.json_object(C()), seen[:1] + ['{"d": "1"}']) == [{"A b": "2", "c": None}, {"d": "1"}]


def test_criteria(values):
    body = ("Key INCLUSION criteria (all):\r\n* Age \\>= 18\n2. Consent;  signed\n\nExclusion Criteria:\n1. Pregnancy • ≥ 3 months\n; ;")
    assert values(text.criteria(C(), "inclusion"), [body]) == [["Age 18", "Consent", "signed"]]
    assert values(text.criteria(C(), "exclusion"), [body]) == [["Pregnancy 3 months"]]
    assert values(text.criteria(C()), [None, "nothing", "Inclusion Criteria: ;"]) == [None, [None], [None]]


def test_terms_clean_and_keep_order(spark):
    df = spark.createDataFrame([("Diseases [C] - Cancer [C04]", "Lung Neoplasms | O'Hara (x) y (z)", "['Virus', \"cancer\"]", None),
                                (None, "", None, None), ("a, b", None, None, "B")], "w string, x string, y string, z string")
    assert [r[0] for r in df.select(text.terms([F.col(c) for c in "wxyz"])).collect()] == [
        ["cancer", "lung neoplasm", "ohara", "virus"], None, ["a", "b"]]


def test_answers(values):
    good = 'ok\n```json\n[{"database_index": 3, "certainty": 0.7, "Title": "json tale"}]\n```\n'
    seen = [good, "no fence", "```json [{ ```", "```\n[]\n```", None]
    got = values(answers.scored_rows(C()), seen)
    assert [None if g is None else [tuple(r) for r in g] for g in got] == [[(3, 0.7, "json tale")], None, None, [], None]


def test_flag_fallback_is_kleene(spark):
    df = spark.createDataFrame([(None, False, True), (None, False, None), (None, True, True), (False, True, None)], "a boolean, b boolean, n boolean")
    assert [r[0] for r in df.select(v.flag_with_fallback(F.col("a"), F.col("b"), F.col("n"))).collect()] == [False, None, True, False]


def test_bare_words_after_any_blanks_and_never_inside_quotes(values):
    texts = ["['a'," + " " * 9 + "None]", "['x, None, y', None]", "[None]", "['it', \"o'k\", True]"]
    assert values(lists.parse_literal(F.col("c")), texts) == [["a", None], ["x, None, y", None], [None], ["it", "o'k", "true"]]
