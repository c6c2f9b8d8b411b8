"""Scalar functions."""

from pyspark.sql import functions as F

from query_book import day, joined, query
from trialweave.functions import answers, lists, text, values
from trialweave.operators import columns


@query("""
SELECT o_orderkey, try_cast(CASE o_orderstatus WHEN 'F' THEN o_totalprice::VARCHAR
         WHEN 'O' THEN o_totalprice::VARCHAR || ' EUR' END AS DOUBLE) AS number
FROM orders""")
def to_numeric(t):
    price = F.col("o_totalprice").cast("string")
    shown = F.when(F.col("o_orderstatus") == "F", price).when(F.col("o_orderstatus") == "O", F.concat(price, F.lit(" EUR")))
    return t.orders.select("o_orderkey", values.to_number(shown).alias("number"))


@query("""
SELECT o_orderkey, strftime(try_strptime(CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN 'O' THEN strftime(o_orderdate, '%d/%m/%Y') END, '%Y-%m-%d'), '%Y-%m-%d') AS day
FROM orders""")
def to_date_fmt(t):
    shown = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
             .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy")))
    return t.orders.select("o_orderkey", day(values.to_day(shown)).alias("day"))


@query("""
SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, nullif(p_type, 'PROMO'), p_name) AS first_known
FROM part""")
def coalesce_chain(t):
    return t.part.select("p_partkey", values.first_known(
        F.when(F.col("p_size") > 25, F.col("p_brand")), values.null_if(F.col("p_type"), "PROMO"), F.col("p_name"),
    ).alias("first_known"))


@query("SELECT o_orderkey, nullif(o_orderstatus = 'F', false) AS flag FROM orders")
def null_if(t):
    return t.orders.select("o_orderkey", values.null_if(F.col("o_orderstatus") == "F", False).alias("flag"))


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS a,
                  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE + (o_custkey % 30 - 15)::INTEGER END AS b
           FROM orders)
SELECT o_orderkey, strftime(least(a, b), '%Y-%m-%d') AS first_day, strftime(greatest(a, b), '%Y-%m-%d') AS last_day
FROM d""")
def row_min_max(t):
    a = F.col("o_orderdate").cast("date")
    b = F.when(F.col("o_orderstatus") != "P", F.date_add(a, (F.col("o_custkey") % 30 - 15).cast("int")))
    return t.orders.select("o_orderkey", day(values.earliest(a, b)).alias("first_day"),
                           day(values.latest(a, b)).alias("last_day"))


@query("""
SELECT l_orderkey, l_linenumber, round(CASE l_linenumber WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity / 12
         WHEN 3 THEN l_quantity / 365 END, 6) AS years
FROM lineitem""")
def age_to_years(t):
    unit = (F.when(F.col("l_linenumber") == 1, "Years").when(F.col("l_linenumber") == 2, "Months")
            .when(F.col("l_linenumber") == 3, "Days").when(F.col("l_linenumber") == 4, "Weeks"))
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             F.round(values.age_in_years(F.col("l_quantity"), unit), 6).alias("years"))


@query("""
WITH p AS (SELECT p_partkey, string_split(concat_ws(', ', p_brand, p_name, p_brand, p_type, p_name), ', ') AS l FROM part)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ', ') AS items FROM p""")
def dedup_inner_list(t):
    shown = F.concat_ws(", ", "p_brand", "p_name", "p_brand", "p_type", "p_name")
    return t.part.select("p_partkey", lists.unique_inside(shown).alias("items"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS "props.k" FROM events""")
def json_to_columns(t):
    return columns.json_to_columns(t.events.select("event_id", "props"), "props")


@query("""
WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS l FROM part)
SELECT p_partkey, list_contains(l, 'red')::INTEGER AS "p_name.red", list_contains(l, 'bolt')::INTEGER AS "p_name.bolt",
       list_contains(l, 'ring')::INTEGER AS "p_name.ring" FROM p""")
def list_indicators(t):
    return columns.list_indicators(t.part.select("p_partkey", "p_name"), "p_name", " ", ["red", "bolt", "ring"])


@query("""
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS item FROM part WHERE p_name <> '')
SELECT p_partkey, 'p_name.' || item AS item, list_contains(string_split(p_name, ' '), item)::INTEGER AS has FROM part, w WHERE item <> ''""")
def list_indicators_learned(t):
    """The columns of all words that part names have, learned from the table, shown one below the other."""
    wide = columns.list_indicators(t.part.select("p_partkey", "p_name"), "p_name", " ")
    return wide.unpivot("p_partkey", [columns.quoted(c) for c in wide.columns if c != "p_partkey"], "item", "has")


@query(r"""
WITH p AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Human pharmacology (Phase I)' WHEN 'SMALL' THEN 'Phase II'
             WHEN 'STANDARD' THEN 'Phase I and Phase II (Integrated)' WHEN 'MEDIUM' THEN 'Phase III'
             WHEN 'PROMO' THEN 'Phase IV - other' END AS d FROM part)
SELECT p_partkey, d, coalesce(regexp_matches(d, '\bPhase I\b'), false)::INTEGER AS "Phase_I",
       coalesce(regexp_matches(d, '\bPhase II\b'), false)::INTEGER AS "Phase_II",
       coalesce(regexp_matches(d, '\bPhase III\b'), false)::INTEGER AS "Phase_III",
       coalesce(regexp_matches(d, '\bPhase IV\b'), false)::INTEGER AS "Phase_IV" FROM p""")
def word_flags(t):
    kind = F.col("p_type")
    described = (F.when(kind == "ECONOMY", "Human pharmacology (Phase I)").when(kind == "SMALL", "Phase II")
                 .when(kind == "STANDARD", "Phase I and Phase II (Integrated)").when(kind == "MEDIUM", "Phase III")
                 .when(kind == "PROMO", "Phase IV - other"))
    df = t.part.select("p_partkey", described.alias("d"))
    return columns.word_flags(df, "d", ["Phase I", "Phase II", "Phase III", "Phase IV"])


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE 'Not known' END AS text,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag
FROM orders""")
def yes_no(t):
    answer = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").otherwise("Not known")
    text_form = values.yes_no(answer)
    return t.orders.select("o_orderkey", text_form.alias("text"), values.to_flag(text_form).alias("flag"))


@query("""
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '[''' || o_orderpriority || ''', "x"]'
             WHEN 'O' THEN o_orderpriority || ' , ,' || o_orderstatus END AS s FROM orders)
SELECT o_orderkey, len(l)::INTEGER AS n, array_to_string(l, '|') AS items
FROM (SELECT o_orderkey, list_filter(CASE WHEN s IS NULL THEN [] WHEN s LIKE '[%'
        THEN list_transform(string_split(trim(s, '[]'), ','), lambda x: trim(x, ' ''"'))
        ELSE list_transform(string_split(s, ','), lambda x: trim(x)) END, lambda x: x <> '') AS l FROM o)""")
def to_list(t):
    shown = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("['"), "o_orderpriority", F.lit("', \"x\"]")))
             .when(F.col("o_orderstatus") == "O", F.concat("o_orderpriority", F.lit(" , ,"), "o_orderstatus")))
    items = lists.to_list(shown)
    return t.orders.select("o_orderkey", F.size(items).alias("n"), joined(items).alias("items"))


@query("""
SELECT p_partkey, CASE WHEN p_size > 10 THEN 1 END::INTEGER AS n, CASE WHEN p_size > 10 THEN p_name END AS items FROM part""")
def ensure_list(t):
    shown = F.when(F.col("p_size") > 10, F.concat(F.lit("  "), "p_name", F.lit("\t")))
    items = lists.ensure_list(shown)
    return t.part.select("p_partkey", F.when(items.isNotNull(), F.size(items)).alias("n"), joined(items).alias("items"))


@query(r"""
WITH d AS (SELECT doc_id, trim('Key Inclusion Criteria (main):' || chr(10) || '1. ' || text || chr(10) || 'Exclusion criteria:'
                  || chr(10) || '* ' || lang || '; ' || source || ' ≥ 2. ' || n_chars) AS s FROM documents),
m AS (SELECT doc_id,
        regexp_extract(s, '(?is)inclusion criteria.*?:\s*(.*?)(?:exclusion criteria|$)', 1) AS i,
        regexp_extract(s, '(?is)exclusion criteria.*?:\s*(.*)$', 1) AS e FROM d),
c AS (SELECT doc_id, list_transform([i, e], lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(x, '^\s+|\s+$', '', 'g'), '\r\n|\r|\n', '; ', 'g'), '[*•\\]', '', 'g'), '≥|≤|>=|<=', ' ', 'g'),
        '\s{2,}', ' ', 'g'), '^[; ]+|[; ]+$', '', 'g')) AS l FROM m),
p AS (SELECT doc_id, list_transform(l, lambda x: list_filter(list_transform(regexp_split_to_array(x, ';\s*|\d+\.\s+'),
        lambda y: regexp_replace(y, '^\s+|\s+$', '', 'g')), lambda y: y <> '')) AS l FROM c)
SELECT doc_id, len(l[1])::INTEGER AS n_inclusion, array_to_string(l[1], '|') AS inclusion,
       array_to_string(l[2], '|') AS exclusion FROM p""")
def extract_criteria(t):
    shown = F.concat(F.lit("Key Inclusion Criteria (main):\n1. "), "text", F.lit("\nExclusion criteria:\n* "), "lang",
                     F.lit("; "), "source", F.lit(" ≥ 2. "), F.col("n_chars").cast("string"))
    included, excluded = text.criteria(shown, "inclusion"), text.criteria(shown, "exclusion")
    return t.documents.select("doc_id", F.size(included).alias("n_inclusion"), joined(included).alias("inclusion"),
                              joined(excluded).alias("exclusion"))


@query(r"""
WITH p AS (SELECT p_partkey, list_concat(['Diseases [C] - ' || p_type || ' [C04]'], string_split(p_name, ' '),
             string_split(p_brand || ', ' || p_type, ','),
             CASE WHEN p_size > 25 THEN ['Benign Neoplasms (all)', 'O Clock'] ELSE [] END) AS l FROM part),
c AS (SELECT p_partkey, list_filter(list_transform(l, lambda x: replace(trim(regexp_replace(trim(regexp_replace(lower(
        replace(replace(x, 'Diseases [C] - ', ''), '''', '')), '\(.*\)', '')), '\[[a-z]+\d+\]', '')), 'neoplasms', 'neoplasm')),
        lambda x: x <> '') AS l FROM p)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS terms FROM c""")
def normalise_terms(t):
    area = F.concat(F.lit("Diseases [C] - "), "p_type", F.lit(" [C04]"))
    words = F.array_join(F.split("p_name", " "), " | ")
    group = F.concat_ws(", ", "p_brand", "p_type")
    condition = F.when(F.col("p_size") > 25, F.lit("['Benign Neoplasms (all)', \"O Clock\"]"))
    return t.part.select("p_partkey", joined(text.terms([area, words, group, condition])).alias("terms"))


@query("SELECT p_partkey, replace(p_name, ' ', ' | ') AS bars, replace(p_name, ' ', ', ') AS commas FROM part")
def list_to_text(t):
    words = F.split("p_name", " ")
    return t.part.select("p_partkey", lists.to_text(words, " | ").alias("bars"), lists.to_text(words).alias("commas"))


@query(r"""
SELECT doc_id, lower(trim(regexp_replace('  ' || text || chr(9), '\s+', ' ', 'g'))) AS text FROM documents""")
def normalise_text(t):
    shown = F.concat(F.lit("  "), "text", F.lit("\t"))
    return t.documents.select("doc_id", text.normalise(shown).alias("text"))


@query("SELECT p_partkey, concat_ws('|', p_name, p_brand, p_type) AS items FROM part")
def bracket_list(t):
    shown = F.concat(F.lit("['"), "p_name", F.lit("', \""), "p_brand", F.lit('", '), "p_type", F.lit("]"))
    return t.part.select("p_partkey", joined(lists.bracket_items(shown)).alias("items"))


@query("""
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN user_id || '/' || event_id WHEN 'click' THEN user_id::VARCHAR
             WHEN 'error' THEN '-' END AS s FROM events)
SELECT event_id, try_cast(string_split(s, '/')[1] AS BIGINT) AS number,
       CASE WHEN s LIKE '%/%' THEN string_split(s, '/')[-1] END AS rest FROM e""")
def split_ratio(t):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    shown = (F.when(kind == "view", F.concat(user, F.lit("/"), F.col("event_id").cast("string")))
             .when(kind == "click", user).when(kind == "error", "-"))
    number, rest = values.split_ratio(shown)
    return t.events.select("event_id", number.alias("number"), rest.alias("rest"))


@query("""
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'Deferido' WHEN 'click' THEN 'INDEFERIDO'
             WHEN 'error' THEN 'em curso' END AS s FROM events)
SELECT event_id, CASE WHEN lower(s) LIKE '%indefer%' THEN false WHEN lower(s) LIKE '%defer%' THEN true END AS flag FROM e""")
def keyword_flag(t):
    kind = F.col("event_type")
    shown = F.when(kind == "view", "Deferido").when(kind == "click", "INDEFERIDO").when(kind == "error", "em curso")
    return t.events.select("event_id", values.keyword_flag(shown, ["indefer"], ["defer"]).alias("flag"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'clinicaltrials.gov' WHEN o_totalprice > 250000
         THEN 'clinicaltrials.eu' ELSE 'unknown' END AS origin FROM orders""")
def infer_source(t):
    study = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))
    sponsor = F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", values.origin(study, sponsor).alias("origin"))


@query("""
SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 400000 THEN o_orderstatus = 'F' END,
         nullif(o_orderpriority = '1-URGENT', false), NOT nullif(o_orderstatus, 'P') = 'O') AS flag FROM orders""")
def flag_fallback(t):
    first = F.when(F.col("o_totalprice") > 400000, F.col("o_orderstatus") == "F")
    return t.orders.select("o_orderkey", values.flag_with_fallback(
        first, F.col("o_orderpriority") == "1-URGENT", F.nullif(F.col("o_orderstatus"), F.lit("P")) == "O").alias("flag"))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS lo,
                  CASE WHEN l_linestatus <> 'O' THEN l_quantity + 20 END AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(lo <= 17 AND hi >= 0, false) AS "Age_0_17_years",
       coalesce(hi <= 64 AND lo >= 18, false) AS "Age_18_64_years", coalesce(lo >= 65, false) AS "Age_65p_years" FROM l""")
def age_bands(t):
    low = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    high = F.when(F.col("l_linestatus") != "O", F.col("l_quantity") + 20)
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             *[c.alias(n) for n, c in values.age_bands(low, high).items()])


@query("""
WITH a AS (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN text || chr(10) || '```json' || chr(10) || '[{"database_index": '
             || conv_id || ', "certainty": 0.' || turn || ', "Title": "' || role || '"}]' || chr(10) || '```' || chr(10)
             WHEN 'user' THEN '```json [{"database_index": ```' ELSE 'no answer' END AS s FROM conversations),
b AS (SELECT conv_id, turn, trim(replace(string_split(s, '```')[-2], 'json', ''), ' ' || chr(10)) AS j FROM a)
SELECT conv_id, turn, CASE WHEN json_valid(j) THEN json_extract(j, '$[0].database_index')::BIGINT END AS database_index,
       CASE WHEN json_valid(j) THEN json_extract(j, '$[0].certainty')::DOUBLE END AS certainty,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$[0].Title') END AS "Title" FROM b""")
def parse_scored_json(t):
    rows = F.concat(F.lit('[{"database_index": '), F.col("conv_id").cast("string"), F.lit(', "certainty": 0.'),
                    F.col("turn").cast("string"), F.lit(', "Title": "'), "role", F.lit('"}]'))
    answer = (F.when(F.col("role") == "assistant", F.concat("text", F.lit("\n```json\n"), rows, F.lit("\n```\n")))
              .when(F.col("role") == "user", '```json [{"database_index": ```').otherwise("no answer"))
    return t.conversations.select("conv_id", "turn", F.inline_outer(answers.scored_rows(answer)))


@query("""
SELECT '- id: ' || o_orderkey || ', Title: ' || o_orderpriority || ', Status: ' || coalesce(nullif(o_orderstatus, 'P'), 'N/D') AS line
FROM orders""")
def row_context(t):
    return t.orders.select(text.labelled_line([
        ("id", F.col("o_orderkey")), ("Title", F.col("o_orderpriority")), ("Status", F.nullif(F.col("o_orderstatus"), F.lit("P"))),
    ]).alias("line"))
