import json

import pytest
from pyspark.sql import functions as F

from trialweave.sources import documents, files, html, jdbc, listings

DETAIL_PAGE = """<html><body><table class="summary">
<tr><td>A.2</td><td>EudraCT number</td><td> 2010-123456-12 </td></tr>
<tr><td>A.3</td><td>Full title</td><td><table><tr><td>A trial of &amp; more</td></tr><tr><td>Segundo</td></tr></table></td></tr>
<tr><td>A.4.1</td><td>Protocol code</td><td>PC-1</td></tr>
<tr><td>B.1.1</td><td>Name of Sponsor</td><td>Acme</td></tr>
<tr><td>E.1.1</td><td>Condition</td><td><table><tr><td> Asthma </td></tr></table></td></tr>
<tr><td>E.1.1.2</td><td>Area</td><td>Diseases [C] - Lung [C08]</td></tr>
<tr><td>E.3</td><td>Inclusion</td><td><table><tr><td>adult</td></tr></table></td></tr>
<tr><td>E.6.1</td><td>Diagnosis</td><td>No</td></tr>
<tr><td>E.7.1</td><td>Human pharmacology (Phase I)</td><td>Yes</td></tr>
<tr><td>E.8.1</td><td>Controlled</td><td></td></tr>
<tr><td>E.8.1.1</td><td>Randomised</td><td>Yes</td></tr>
<tr><td>E.8.2</td><td>Open</td><td>Not known</td></tr>
<tr><td>F.1.2</td><td>Adults (18-64 years)</td><td>Yes</td></tr>
<tr><td>F.2.1</td><td>Female</td><td>Yes</td></tr><tr><td>F.2.2</td><td>Male</td><td>No</td></tr>
<tr><td>N.</td><td>Date of Competent Authority Decision</td><td>2011-02-03</td></tr>
<tr><td>P.</td><td>End of Trial Status</td><td>Ongoing</td></tr>
</table></body></html>"""

PROGRAMMES = """<table><thead><tr><th>Nome</th><th>DCI</th><th>Dec</th><th>Data</th><th>Det</th><th>N</th><th>Obs</th></tr></thead>
<tbody><tr><td>P1</td><td>abc</td><td>Deferido</td><td>01/02/2020</td><td>d</td><td>12/3</td><td>PAP ativo com custos</td></tr>
<tr><td>P2</td><td>def</td><td>Indeferido</td><td>31/02/2020</td><td>e</td><td>-</td><td>sem custos</td></tr><tr><td> </td></tr></tbody></table>"""


def test_older_register_page(spark):
    df = spark.createDataFrame([(DETAIL_PAGE, "http://r/1"), (None, "http://r/2")], "html string, url string")
    row = html.older_register(df, "html", "url").where("url = 'http://r/1'").first()
    assert row["eudract_nr"] == "2010-123456-12" and row["title"] == "A trial of & more\nSegundo"
    assert json.loads(row["trial_design"]) == {"Controlled": "", "Randomised": "1", "Open": "Not known"}
    assert json.loads(row["trial_scope"]) == {"Diagnosis": "0"} and json.loads(row["condition"]) == ["Asthma"]
    assert row["Age_Adults_(18-64_years)"] == "1" and (row["Gender_F"], row["Gender_M"]) == ("1", "0")
    assert row["start_date"] == "2011-02-03" and row["end_date"] is None and row["status"] == "Ongoing"


def test_programme_table(spark):
    df = spark.createDataFrame([(PROGRAMMES,)], "html string")
    rows = html.programme_table(df, "html").orderBy("Nome").collect()
    assert [(r["Nome"], r["n_doentes"], r["recurr_n_dtes"], r["PAP_act"], r["c_custos"], r["deferimento"]) for r in rows] == [
        ("P1", 12, "3", True, True, True), ("P2", None, None, False, False, False)]


ODD_PAGES = [
    DETAIL_PAGE, PROGRAMMES, None, "", "no table", "<!DOCTYPE html><title>a &amp; b</title><table><tr><td>x<!-- c -->y<br/>z</td><td>&nbsp;</td></table>",
    "<table><tr><td>a < b</td><TD class='q' x=1>&lt;c&gt;<td>open<tr><th>h</table>", "<script>if (a<b) x('<td>')</script><table><tr><td a=x/>1</td></tr></table>",
    "<table><tr><td>1<table><tr><td>2</td></tr></table>3</td></tr></table>", "<td>outside</td><table><tr><td><b>in</b> side</td", "<table><tr><td>&am"]


def test_pages_leave_a_worker_a_few_at_a_time(spark):
    """Arrow batches hold thousands of pages; their rows must not be held together."""
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ODD_PAGES * 100)], "i int, html string").coalesce(1)
    import pyarrow as pa

    made = []
    plain, html.F.arrow_udf = html.F.arrow_udf, lambda kind: lambda f: made.append(f) or (lambda c: None)
    try:
        html.table_rows(None)
    finally:
        html.F.arrow_udf = plain
    sizes = [len(a) for a in made[0](iter([pa.array(ODD_PAGES * 100), pa.array(["x" * html.CHUNK_CHARS] * 3)]))]
    assert sum(sizes) == len(ODD_PAGES) * 100 + 3 and max(sizes) <= html.CHUNK_PAGES and sizes[-3:] == [1, 1, 1]
    found = {}
    for r in df.select("i", html.table_rows(F.col("html")).alias("r")).collect():
        found.setdefault(r["i"] % len(ODD_PAGES), set()).add(str(r["r"]))
    assert all(len(rows) == 1 for rows in found.values())


def test_rows_are_those_of_the_standard_parser(spark, monkeypatch):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ODD_PAGES)], "i int, html string")
    fast = df.select("i", html.table_rows(F.col("html")).alias("r")).orderBy("i").collect()
    # A pattern that fits nothing sends every page to the standard parser.
    monkeypatch.setattr(html, "_TAG", __import__("re").compile("(?!)()()()()"))
    assert fast == df.select("i", html.table_rows(F.col("html")).alias("r")).orderBy("i").collect()
    assert [len(r["r"]) for r in fast] == [21, 4, 0, 0, 0, 1, 2, 1, 2, 1, 1]


def test_table_rows_are_dealt_over_all_tasks(spark, tmp_path):
    from query_book import dealt

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    spread = dealt(spark.read.parquet(str(tmp_path / "one")))
    assert spread.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism and spread.count() == 100


def test_links_become_absolute(values):
    base = F.lit("https://h.example/a/b?x=1#f")
    seen = ["http://o/z", "//o/z", "/r", "?q=2", "#t", "c.html", ""]
    assert values(html.absolute(F.col("c"), base), seen) == [
        "http://o/z", "https://o/z", "https://h.example/r", "https://h.example/a/b?q=2", "https://h.example/a/b?x=1#t",
        "https://h.example/a/c.html", "https://h.example/a/b?x=1#f"]
    assert values(html.absolute(F.col("c"), F.lit("http://h")), ["d"]) == ["http://h/d"]
    assert values(html.next_page(F.col("c"), "Next»"), ['<a href="?p=1">1</a> <a href="?p=2"><b>Next»</b></a>', "x"]) == ["?p=2", None]


def test_newer_register(spark):
    def page(number, *records):
        return (json.dumps({"pagination": {"currentPage": number, "totalPages": 2}, "data": list(records)}),)
    pages = spark.createDataFrame([page(2, {"ctNumber": "1", "ctTitle": "new"}), page(1, {"ctNumber": "1", "ctTitle": "old"}, {"ctTitle": "no id"})], "body string")
    detail = {"ctNumber": "1", "authorizedApplication": {"authorizedPartI": {"trialDetails": {"trialInformation": {
        "eligibilityCriteria": {"principalInclusionCriteria": [{"principalInclusionCriteria": "adult"}, {}], "principalExclusionCriteria": []}}}}}}
    details = spark.createDataFrame([(json.dumps(detail), "u")], "doc string, url string")
    row = listings.newer_register(pages, "body", details, "doc").collect()
    assert len(row) == 1 and row[0]["title"] == "new" and row[0]["start_date"] is None
    assert json.loads(row[0]["inclusion_crt"]) == ["adult", ""] and row[0]["exclusion_crt"] is None


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "2020-01-01", "a", None), (None, "2", "false", None, "1", None)],
                               "i string, d string, b string, t string, s string, e string")
    assert dict(files.infer_types(df).dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "t": "date", "s": "string", "e": "string"}
    assert files.infer_types(spark.createDataFrame([("007",), ("1d",)], "x string")).dtypes == [("x", "string")]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", None], 'q"\n,'), (2, None, None)], "i int, l array<string>, s string")
    files.write_tagged(df, f"{tmp_path}/tagged")
    assert sorted(files.read_tagged(spark, f"{tmp_path}/tagged", ["l"]).collect()) == sorted(df.collect())
    files.write_csv(df, f"{tmp_path}/csv")
    back = {r["i"]: r["s"] for r in files.read_csv(spark, f"{tmp_path}/csv", "i int, l string, s string", line_breaks=True).collect()}
    assert back == {1: 'q"\n,', 2: None}
    run = files.land_with_report(df, str(tmp_path), "src", F.col("l").isNull())
    files.append_run(run, f"{tmp_path}/runs")
    assert spark.read.parquet(f"{tmp_path}/runs").select("items", "errors").first() == (2, 1)
    seen = files.inventory(spark, {"tagged": f"{tmp_path}/tagged"}).first()
    assert seen["total_records"] == 2 and seen["last_update"] is not None


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:postgresql://h/db", "ctgov.studies", "u", "p")
    assert plain["dbtable"] == "ctgov.studies" and "partitionColumn" not in plain
    parts = jdbc.jdbc_options("jdbc:x", "t", "u", "p", "id", (1, 9), 4)
    assert (parts["lowerBound"], parts["upperBound"], parts["numPartitions"]) == ("1", "9", "4")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "u", "p", "id")
    assert jdbc.prefix_predicates("nct_id", ["NCT03", "NCT01"]) == [
        "nct_id < 'NCT01' OR nct_id IS NULL", "nct_id >= 'NCT01' AND nct_id < 'NCT03'", "nct_id >= 'NCT03'"]


def test_labels_stay_with_their_values_over_markup(values):
    page = "<dl><dt>A</dt><dd><b>1</b></dd><dt>None</dt><dt>B <i>x</i></dt><dd>2</dd></dl>"
    assert values(html.label_values(F.col("c"), "dt", "dd"), [page, "", None]) == [{"A": "1", "B x": "2"}, {}, None]


def test_links_in_any_quotes_and_with_dots(spark):
    page = """<a href=' ../b?x=1&amp;y=2 '>1</a><a class=k href=c/./d.html>2</a><a href="../../../up/..">3</a>"""
    df = spark.createDataFrame([(page, "http://h/a/c/e")], "html string, url string")
    assert [r["link"] for r in html.links(df, "html", "url").orderBy("place").collect()] == [
        "http://h/a/b?x=1&y=2", "http://h/a/c/c/d.html", "http://h/"]


def test_codes_and_long_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([("007", "12345678901234567890", "1.5"), ("012", "12345678901234567891", "2")], "a string, b string, c string")
    got = files.infer_types(df)
    assert [k for _, k in got.dtypes] == ["string", "decimal(38,0)", "double"] and got.select("b").distinct().count() == 2


def test_csv_files_are_cut_unless_they_may_hold_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("", 1), (None, 2), ("  pad ", 3), ('q"', 4)], "s string, i int")
    files.write_csv(df, f"{tmp_path}/x")
    got = files.read_csv(spark, f"{tmp_path}/x", "s string, i int")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [tuple(r) for r in df.collect()]


def test_an_unreadable_document_does_not_lose_its_trial(spark):
    body = '{"pagination":{"currentPage":1},"data":[{"ctNumber":"1","ctTitle":"t"},{"ctNumber":"2","ctTitle":"u"}]}'
    pages = spark.createDataFrame([(body,)], "body string")
    details = spark.createDataFrame([('{"ctNumber":"1"}', "u1"), ("broken", "u2")], "doc string, url string")
    assert sorted(r["eudract_nr"] for r in listings.newer_register(pages, "body", details, "doc").collect()) == ["1", "2"]


def test_all_character_references_are_decoded_once(values):
    seen = ["/x?a=1&#38;b=2&#x26;c=3", "&amp;lt;&lt;", "&nosuch;&Aacute;&#128;&#0;&#xD800;&#1114112;", "&copy", "&", None, "&#128512;&#X41;"]
    assert values(html.decoded(F.col("c")), seen) == [
        "/x?a=1&b=2&c=3", "&lt;<", "&nosuch;Á€���", "&copy", "&", None, "\U0001f600A"]


def test_undeclared_fields_are_learned_from_the_documents(spark):
    rows = ['{"id":"1","known":{"a":1},"new":{"x y":"v","list":[1,2]},"items":[{"k":1},{"m":2}]}', '{"id":"2","new":{"x y":3,"d.e":null,"it\'s":true}}', "broken", None, "[1]", '"text"']
    df = spark.createDataFrame([(r,) for r in rows], "doc string").withColumn("v", documents.parsed(F.col("doc")))
    got = documents.with_undeclared(df, "v", [("id",), ("known", "a"), ("items", "k")], "doc")
    assert got.columns == ["doc", "v", "doc.items", "doc.new.d.e", "doc.new.it's", "doc.new.list", "doc.new.x y"]
    first, second = got.where("doc LIKE '{%'").orderBy("doc").drop("doc", "v").collect()
    assert tuple(first) == ('[{"k":1},{"m":2}]', None, None, "[1,2]", "v") and tuple(second) == (None, None, "true", None, "3")
    whole = documents.with_undeclared(df, "v", [("id",), ("known", "a"), ("items", "k"), ("items", "m"), ("new", "list")], "doc")
    assert "doc.items" not in whole.columns and "doc.new.list" not in whole.columns
    with pytest.raises(ValueError, match="more than 1"):
        documents.with_undeclared(df, "v", [], "doc", limit=1)
    assert documents.with_undeclared(df.limit(0), "v", [], "doc").columns == ["doc", "v"]


def test_the_newest_document_of_a_trial_counts_once(spark):
    body = '{"pagination":{"currentPage":1},"data":[{"ctNumber":"1","ctTitle":"t","note":"n"},{"ctNumber":"2","extra":{"e":1}}]}'
    pages = spark.createDataFrame([(body,)], "body string")
    docs = [('{"ctNumber":"1","seen":"old"}', "u1", 1), ('{"ctNumber":"1","seen":"new"}', "u2", 2), ('{"ctNumber":"1","seen":"undated"}', "u3", None), ("broken", "u4", 9)]
    details = spark.createDataFrame(docs, "doc string, url string, at int")
    plain = {r["eudract_nr"]: r["url"] for r in listings.newer_register(pages, "body", details, "doc", fetched="at").collect()}
    assert plain == {"1": "u2", "2": None}
    assert listings.newer_register(pages, "body", details, "doc").count() == 2
    rows = {r["eudract_nr"]: r for r in listings.newer_register(pages, "body", details, "doc", fetched="at", undeclared=True).collect()}
    assert rows["1"]["listing.note"] == "n" and rows["1"]["detail.seen"] == "new" and rows["2"]["listing.extra.e"] == "1" and len(rows) == 2


def parse_here(monkeypatch, make, pages):
    """What the worker makes of pages, without a session."""
    import pyarrow as pa

    made = []
    with monkeypatch.context() as patch:
        patch.setattr(html.F, "arrow_udf", lambda kind: lambda f: made.append(f) or (lambda c: None))
        make()
    return [x for part in made[0](iter([pa.array(pages, pa.string())])) for x in part.to_pylist()]


def nested_page(rng, depth=0):
    texts = ["a", " b\n", "\xa0", " \xa0 ", "é", "&amp;", "&nbsp;", "1 > 0", "日本", "", " ", "\x1c"]
    out = []
    for _ in range(rng.randrange(1, 4)):
        kind = rng.random()
        if kind < 0.5 and depth < 4:
            rows = []
            for _ in range(rng.randrange(4)):
                cells = [rng.choice(["td", "TD", "th"]) for _ in range(rng.randrange(4))]
                rows.append("<tr>" + "".join(f"<{c} class='x y'>{nested_page(rng, depth + 1)}</{c}>{rng.choice(texts)}" for c in cells) + "</tr>")
            out.append(f"<table><tbody>{''.join(rows)}</tbody></table>")
        else:
            out.append(rng.choice([*texts, *texts, "<b>x</b>", "<br>", "<hr/>", "<!-- c -->", "<title>t</title>", "<script>s</script>", "<div/>", "</br>"]))
    return "".join(out)


def test_closed_pages_are_parsed_together_with_the_same_rows(monkeypatch):
    """Only pages whose elements are not closed in their order pass a parser one by one."""
    import random

    rng = random.Random(4)
    closed = [DETAIL_PAGE, PROGRAMMES, None, "", "no table", *(nested_page(rng) for _ in range(300))]
    broken = [p[:i] + p[i + 3:] for p in closed if p and len(p) > 40 for i in [rng.randrange(len(p) - 3)]] + ODD_PAGES[5:]
    single, parser = [], html.HTMLParser

    class Counted(parser):
        def __init__(self, **options):
            single.append(1)
            super().__init__(**options)

    monkeypatch.setattr(html, "HTMLParser", Counted)

    def rows(pages):
        return parse_here(monkeypatch, lambda: html.table_rows(None), pages)

    together = rows(closed)
    assert not single
    mixed = [p for pair in zip(closed, broken) for p in pair]
    found = rows(mixed)
    assert 0 < len(single) < len(mixed)
    # A pattern that fits nothing sends every page to the standard parser.
    monkeypatch.setattr(html, "_TAG", __import__("re").compile("(?!)()()()()"))
    assert together == rows(closed) and found == rows(mixed)


def test_texts_of_rows_by_code_and_label(monkeypatch):
    def page(*rows):
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in rows) + "</table>"

    inner = "<table><tr><td>n1</td></tr><tr><td> n2 </td></tr></table>"
    pages = [
        page(("A.\n 1", "L", "x<b>y</b>"), ("A. 1", "L", "z" + inner)), page(("A. 1", "L", ""), ("A. 1 ", "M", "late")),
        page(("A. 1", "L", "first"), ("A. 1", "L")), page(("p A. 1", "\xa0K\x1c", " v "), ("A. 1",)), None, "<td>A. 1", page()]
    got = parse_here(monkeypatch, lambda: html.row_texts(
        None, {"one": ("code", "A. 1", "all"), "own": ("label", "L", "own"), "has": ("contains", "A.", "all")}, {"every": ("code", "A. 1", "nested"), "labels": ("label", "L", "all")},
        {"pairs": "A. 1"}), pages)
    assert [r["one"] for r in got] == ["x", "late", None, None, None, None, None]
    assert [r["own"] for r in got] == ["x", None, None, None, None, None, None]
    assert [r["has"] for r in got] == ["x", "late", None, None, None, None, None]
    assert [r["every"] for r in got] == [["n1", " n2 "], [], None, None, [], [], []]
    assert [r["labels"] for r in got] == [["x", "y", "z", "n1", " n2 "], [], None, [], [], [], []]
    assert [[tuple(p.values()) for p in r["pairs"]] for r in got] == [
        [("L", "z")], [("L", ""), ("M", "late")], [("L", "first"), ("L", None)], [("K", "v"), (None, None)], [], [], []]
