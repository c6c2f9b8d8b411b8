"""Pages and documents of the trial registers, built from whole driver tables."""

from pyspark.sql import functions as F

from query_book import dealt, query
from trialweave.sources import html, listings


@query("SELECT p_partkey, p_name AS name, p_brand AS brand, NULL::VARCHAR AS empty FROM part")
def label_values(t):
    """A label without a value stands between two with one, and a value holds markup."""
    page = F.format_string("<dl class='x'><dt>Name</dt>\n<dd><b>%s</b></dd><dt>Empty</dt><dt> Brand </dt><dd>%s</dd></dl>", "p_name", "p_brand")
    pairs = html.label_values(page, "dt", "dd")
    return t.part.select("p_partkey", *[F.try_element_at(pairs, F.lit(k)).alias(k.lower()) for k in ("Name", "Brand", "Empty")])


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '?page=' || o_custkey || '&sort=a' WHEN 'O' THEN '/list/' || o_custkey END AS next FROM orders""")
def next_page_link(t):
    first = F.lit("<a href=\"?page=1\">1</a> ")
    page = (F.when(F.col("o_orderstatus") == "F", F.concat(first, F.format_string("<a class=n href='?page=%d&amp;sort=a'><b>Next »</b></a>", "o_custkey")))
            .when(F.col("o_orderstatus") == "O", F.concat(first, F.format_string("<a href=/list/%d >Next »</a>", "o_custkey"))).otherwise(first))
    return t.orders.select("o_orderkey", html.next_page(page, "Next »").alias("next"))


def yes(condition):
    return F.when(condition, "Yes").otherwise("No")


@query("""
SELECT 'https://register.example/' || o_orderkey AS url, 'Trial ' || o_orderkey || ' & more' AS title, '2010-' || o_orderkey AS eudract_nr,
  'PC-' || o_custkey AS "Protocol", 'Clinic ' || o_custkey % 40 AS "Sponsor", '["Condition ' || o_custkey % 9 || '","Fever"]' AS condition,
  'Diseases [C] - Area ' || o_custkey % 12 || ' [C04]' AS therapeutic_area, '["adult ' || o_custkey % 80 || '"]' AS inclusion_crt, '["none"]' AS exclusion_crt,
  '{"Human pharmacology (Phase I)":"' || o_custkey % 2 || '"}' AS trial_phase, '{"Controlled":"' || o_orderkey % 2 || '","Open":"Not known"}' AS trial_design,
  (o_custkey % 2)::VARCHAR AS adults, (o_orderkey % 2)::VARCHAR AS "Gender_F", '0' AS "Gender_M", strftime(o_orderdate, '%Y-%m-%d') AS start_date,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Ongoing' END AS status FROM orders""")
def older_register_page(t):
    """Orders as detail pages of the older register: nested tables, references, an open row."""
    def row(code, label, value):
        return F.concat(F.lit(f"<tr><td>{code}</td><td>{label}</td><td>"), value, F.lit("</td></tr>\n"))

    def nested(*values):
        return F.concat(F.lit("<table>"), *[F.concat(F.lit("<tr><td> "), v, F.lit(" </td></tr>")) for v in values], F.lit("</table>"))

    odd, age = F.col("o_orderkey") % 2 == 1, F.col("o_custkey")
    page = F.concat(
        F.lit("<html><body><table class='summary'>"),
        row("A.2", "EudraCT number", F.format_string(" 2010-%d ", "o_orderkey")), row("A.3", "Full title", nested(F.format_string("Trial %d &amp; more", "o_orderkey"))),
        row("A.4.1", "Protocol code", F.format_string("PC-%d", "o_custkey")), row("B.1.1", "Name of Sponsor", F.format_string("Clinic %d", age % 40)),
        row("E.1.1", "Condition", nested(F.format_string("Condition %d", age % 9), F.lit("Fever"))),
        row("E.1.1.2", "Area", F.format_string("Diseases [C] - Area %d [C04]", age % 12)),
        row("E.3", "Inclusion", nested(F.format_string("adult %d", age % 80))), row("E.4", "Exclusion", nested(F.lit("none"))),
        row("E.7.1", "Human pharmacology (Phase I)", yes(age % 2 == 1)), row("E.8.1", "Controlled", yes(odd)), row("E.8.2", "Open", F.lit("Not known")),
        row("F.1.2", "Adults (18-64 years)", yes(age % 2 == 1)), row("F.2.1", "Female", yes(odd)), row("F.2.2", "Male", F.lit("No")),
        row("N.", "Date of Competent Authority Decision", F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.when(F.col("o_orderstatus") != "P", row("P.", "End of Trial Status", F.when(F.col("o_orderstatus") == "F", "Completed").otherwise("Ongoing"))).otherwise(""),
        F.lit("</table></body></html>"))
    pages = dealt(t.orders).select(page.alias("html"), F.format_string("https://register.example/%d", "o_orderkey").alias("url"))
    found = html.older_register(pages, "html", "url", ["Adults (18-64 years)"])
    return found.select("url", "title", "eudract_nr", "Protocol", "Sponsor", "condition", "therapeutic_area", "inclusion_crt", "exclusion_crt", "trial_phase",
                        "trial_design", F.col("`Age_Adults_(18-64_years)`").alias("adults"), "Gender_F", "Gender_M", "start_date", "status")


@query("""
SELECT 'Programme ' || event_id AS "Nome", 'substance ' || user_id % 30 AS "DCI", CASE WHEN event_id % 3 = 0 THEN 'Indeferido' ELSE 'Deferido' END AS decisao,
  strftime(ts, '%d/%m/%Y') AS data_decisao, CASE WHEN event_id % 2 = 0 THEN user_id END AS n_doentes,
  CASE WHEN event_id % 2 = 0 THEN (event_id % 5)::VARCHAR END AS recurr_n_dtes, event_id % 4 = 0 AS "PAP_act", event_id % 4 = 0 AS c_custos,
  event_id % 3 <> 0 AS deferimento FROM events""")
def programme_page(t):
    """Events as tables of fifty programmes with a header row."""
    def cells(tag, *values):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>")) for v in values], F.lit("</tr>"))

    number = F.col("event_id")
    row = cells(
        "td", F.format_string(" Programme %d ", number), F.format_string("substance %d", F.col("user_id") % 30),
        F.when(number % 3 == 0, "Indeferido").otherwise("Deferido"), F.date_format("ts", "dd/MM/yyyy"), F.lit("details"),
        F.when(number % 2 == 0, F.format_string("%d/%d", "user_id", number % 5)).otherwise("-"),
        F.when(number % 4 == 0, "PAP ativo com custos").otherwise("encerrado sem custos"))
    head = cells("th", *[F.lit(x) for x in ("Nome", "DCI", "Decisão", "Data", "Detalhes", "N", "Obs")])
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", row.alias("r")))), lambda e: e["r"]), "\n")
    pages = t.events.groupBy(F.expr("event_id div 50").alias("page")).agg(F.concat(F.lit("<table>"), head, body, F.lit("</table>")).alias("html"))
    return html.programme_table(pages, "html").select(
        "Nome", "DCI", "decisao", "data_decisao", F.col("n_doentes").cast("long").alias("n_doentes"), "recurr_n_dtes", "PAP_act", "c_custos", "deferimento")


@query("""
SELECT 'Trial ' || o_orderkey AS title, o_orderkey::VARCHAR AS eudract_nr, 'Phase ' || o_custkey % 4 AS trial_phase_desc,
  'S' || o_custkey AS "Sponsor", '0-17 years' AS "Age", 'Female' AS "Gender", (o_custkey % 90)::VARCHAR AS nr_enrolled, 'Ended' AS status,
  CASE WHEN o_orderstatus <> 'P' THEN 'first' END AS trial_phase, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS start_date,
  CASE o_orderstatus WHEN 'F' THEN '["age ' || o_custkey % 80 || '",""]' END AS inclusion_crt,
  CASE WHEN o_orderstatus <> 'P' THEN 'https://register.example/' || o_orderkey END AS url FROM orders""")
def newer_register(t):
    """Orders on listing pages, each on two of them with an older title on the earlier; a document is broken where the status is P."""
    found = listings.newer_register(listing_pages(t), "body", detail_documents(t), "doc")
    return found.select("title", "eudract_nr", "trial_phase_desc", "Sponsor", "Age", "Gender", "nr_enrolled", "status", "trial_phase", "start_date",
                        "inclusion_crt", "url")


def listing_pages(t):
    def record(title):
        return F.struct(
            F.col("o_orderkey").cast("string").alias("ctNumber"), title.alias("ctTitle"), F.format_string("Phase %d", F.col("o_custkey") % 4).alias("trialPhase"),
            F.format_string("S%d", "o_custkey").alias("sponsor"), F.lit("0-17 years").alias("ageGroup"), F.lit("Female").alias("gender"),
            (F.col("o_custkey") % 90).cast("string").alias("totalNumberEnrolled"), F.lit("Ended").alias("ctStatus"),
            F.when(F.col("o_custkey") % 3 == 0, F.format_string("y%d", "o_custkey")).alias("last updated"))

    number = F.expr("o_orderkey div 100")

    def paged(shift, title):
        data = F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", record(title).alias("r")))), lambda e: e["r"])
        return t.orders.groupBy((number + shift).alias("n")).agg(data.alias("data"))

    listed = paged(0, F.lit("old title")).unionByName(paged(1_000_000, F.format_string("Trial %d", "o_orderkey")))
    return listed.select(F.to_json(F.struct(F.struct(F.col("n").alias("currentPage")).alias("pagination"), "data")).alias("body"))


def detail_documents(t):
    criteria = F.when(F.col("o_orderstatus") == "F", F.array(
        F.struct(F.format_string("age %d", F.col("o_custkey") % 80).alias("principalInclusionCriteria")),
        F.struct(F.lit(None).cast("string").alias("principalInclusionCriteria"))))
    information = F.struct(
        F.struct(F.lit("first").alias("trialPhase")).alias("trialCategory"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("estimatedRecruitmentStartDate")).alias("trialDuration"),
        F.struct(criteria.alias("principalInclusionCriteria")).alias("eligibilityCriteria"))
    places = F.when(F.col("o_custkey") % 2 == 0, F.array(F.struct(F.col("o_custkey").alias("site")), F.struct(F.lit(7).cast("long").alias("site"))))
    part = F.struct(F.struct(F.struct(information.alias("trialInformation")).alias("trialDetails")).alias("authorizedPartI"),
                    F.struct(F.col("o_orderpriority").alias("member.state")).alias("authorizedPartII"))
    document = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("ctNumber"), part.alias("authorizedApplication"), places.alias("places")))
    return t.orders.select(F.when(F.col("o_orderstatus") == "P", "{broken").otherwise(document).alias("doc"),
                           F.format_string("https://register.example/%d", "o_orderkey").alias("url"), F.lit(2).alias("fetched"))


@query("""
SELECT 'Trial ' || o_orderkey AS title, o_orderkey::VARCHAR AS eudract_nr, CASE WHEN o_custkey % 3 = 0 THEN 'y' || o_custkey END AS updated,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS state, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS start_date,
  CASE WHEN o_orderstatus <> 'P' AND o_custkey % 2 = 0 THEN '[{"site":' || o_custkey || '},{"site":7}]' END AS places,
  CASE WHEN o_orderstatus <> 'P' THEN 'https://register.example/' || o_orderkey END AS url, 3 AS undeclared FROM orders""")
def open_register(t):
    """Fields that nobody declared: one in the listing, two in the documents, each of which was fetched twice."""
    now = detail_documents(t)
    earlier = now.withColumns({"doc": F.replace("doc", F.lit("trialDuration"), F.lit("formerDuration")), "url": F.lit("old"), "fetched": F.lit(1)})
    found = listings.newer_register(listing_pages(t), "body", earlier.unionByName(now), "doc", fetched="fetched", undeclared=True)
    extra = [c for c in found.columns if c.startswith(("listing.", "detail."))]
    return found.select("title", "eudract_nr", F.col("`listing.last updated`").alias("updated"), F.col("`detail.authorizedApplication.authorizedPartII.member.state`").alias("state"),
                        "start_date", F.col("`detail.places`").alias("places"), "url", F.lit(len(extra)).alias("undeclared"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'https://register.example/t?a=' || o_custkey || '&b=é€&lt;' WHEN 'O' THEN 'https://register.example/l/Ω–' || o_custkey
  ELSE 'https://register.example/x&nosuch;y' END AS link FROM orders""")
def encoded_links(t):
    """Addresses with named, decimal and hexadecimal character references, one of them written twice over, and an unknown one."""
    target = (F.when(F.col("o_orderstatus") == "F", F.format_string("t?a=%d&#38;b=&#xE9;&euro;&amp;lt;", "o_custkey"))
              .when(F.col("o_orderstatus") == "O", F.format_string("/l/&Omega;&#150;%d", "o_custkey")).otherwise("x&nosuch;y"))
    pages = t.orders.select("o_orderkey", F.concat(F.lit('<p><a href="'), target, F.lit('">x</a></p>')).alias("html"), F.lit("https://register.example/").alias("url"))
    return html.links(pages, "html", "url").select("o_orderkey", "link")
