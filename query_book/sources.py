"""Reading, parsing, landing and writing."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from query_book import joined, query
from trialweave.functions import lists
from trialweave.sources import files, html, landing, listings

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@query("SELECT * FROM orders")
def scan_parquet(t):
    return files.read_parquet(t.spark, t.path("orders"))


@query("""
SELECT * REPLACE (CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' || c_name || ' ' WHEN 2 THEN 'a "quoted", ' || c_name WHEN 3 THEN NULL
  ELSE 'two' || chr(10) || 'lines' END AS c_name) FROM customer""")
def csv_roundtrip(t):
    """Empty, padded, quoted, missing and two-line names."""
    name, kind = F.col("c_name"), F.col("c_custkey") % 5
    odd = (F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("  "), name, F.lit(" "))).when(kind == 2, F.concat(F.lit('a "quoted", '), name))
           .when(kind == 3, F.lit(None)).otherwise("two\nlines"))
    path = t.scratch("csv")
    files.write_csv(t.customer.withColumn("c_name", odd), path)
    return files.read_csv(t.spark, path, t.customer.schema, line_breaks=True)


@query("SELECT * FROM supplier")
def land_source(t):
    root = t.scratch("landing")
    landing.land(t.supplier, root, "supplier")
    return landing.read_landed(t.spark, root, "supplier")


@query("""
SELECT 'first' AS step, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, 1::BIGINT AS newest FROM orders
UNION ALL SELECT 'failed', count(*), sum(o_orderkey)::BIGINT, 1 FROM orders
UNION ALL SELECT 'second', count(*), sum(o_orderkey)::BIGINT, 2 FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'first again', count(*), sum(o_orderkey)::BIGINT, 2 FROM orders""")
def land_versions(t):
    """A good landing, one that fails on its way, a second good one, and what a reader finds after each."""
    root, source = t.scratch("landing"), "orders"

    def seen(step, version=None):
        df = landing.read_landed(t.spark, root, source, version)
        newest = landing.versions(t.spark, root, source).agg(F.max("version")).first()[0]
        return df.agg(F.lit(step).alias("step"), F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"), F.lit(newest).cast("long").alias("newest"))

    landing.land(t.orders, root, source, cluster_by=["o_orderkey"])
    steps = [seen("first")]
    worst = t.orders.agg(F.max("o_orderkey")).first()[0]
    broken = t.orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") == worst, F.raise_error(F.lit("bad record"))).otherwise(F.col("o_orderpriority")))
    files.land_with_report(broken, root, source, F.lit(False))
    steps.append(seen("failed"))
    landing.land(t.orders.where("o_orderstatus <> 'F'"), root, source)
    steps += [seen("second"), seen("first again", 1)]
    return reduce(DataFrame.unionByName, steps)


@query("""
WITH a AS (SELECT user_id, event_type, event_id // 50 AS page FROM events WHERE event_id % 3 <> 0 AND user_id % 5 <> 4
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
b AS (SELECT user_id, event_type, event_id // 50 AS page, event_type = 'view' AS viewed FROM events WHERE user_id % 5 IN (1, 4)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT coalesce(b.user_id, a.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN a.event_type ELSE b.event_type END AS event_type,
  CASE WHEN b.user_id IS NULL THEN a.page ELSE b.page END AS page, b.viewed,
  CASE WHEN b.user_id IS NULL THEN 'kept' WHEN a.user_id IS NULL THEN 'new' ELSE 'changed' END AS kind
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id""")
def refresh_listing(t):
    """Users as records of a listing: a first crawl, then one of some users, with a field more; the table and its change log."""
    root, record = t.scratch("landing"), [F.col("user_id"), F.col("event_type"), F.expr("event_id div 50").alias("page"), F.col("event_id")]
    order = [F.desc("event_id")]
    first = t.events.where("event_id % 3 <> 0 AND user_id % 5 <> 4").select(*record)
    second = t.events.where("user_id % 5 IN (1, 4)").select(*record, (F.col("event_type") == "view").alias("viewed"))
    landing.refresh(first, root, "listing", "user_id", order, buckets=16)
    version = landing.refresh(second, root, "listing", "user_id", order)
    log = landing.change_log(t.spark, root, "listing").where(F.col("version") == version).select(F.col("key").cast("long").alias("user_id"), "kind")
    table = landing.read_landed(t.spark, root, "listing").drop("event_id")
    return table.join(log, "user_id", "left").withColumn("kind", F.coalesce("kind", F.lit("kept")))


@query("""
SELECT event_id, ts, user_id, event_type, value, nullif(event_id % 7, 0) AS gaps, event_type = 'view' AS viewed,
  '00' || user_id AS code, '1234567890123456789' || lpad(event_id::VARCHAR, 8, '0') AS long_id FROM events""")
def infer_types(t):
    landed = t.events.select(
        F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string"), "event_type", F.col("value").cast("string"),
        F.nullif(F.col("event_id") % 7, F.lit(0)).cast("string").alias("gaps"),
        (F.col("event_type") == "view").cast("string").alias("viewed"),
        F.concat(F.lit("00"), F.col("user_id")).alias("code"),
        F.concat(F.lit("1234567890123456789"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias("long_id"))
    df = files.infer_types(landed)
    # Shown as text, as engines print long decimals alike.
    assert dict(df.dtypes)["long_id"] == "decimal(38,0)"
    return df.withColumn("long_id", F.col("long_id").cast("string"))


def priority_lists(t):
    found = t.orders.groupBy("o_custkey").agg(
        F.sort_array(F.collect_set(F.nullif("o_orderpriority", F.lit("5-LOW")))).alias("items"))
    return found.select("o_custkey", F.when(F.size("items") > 0, F.array_append("items", F.lit(None).cast("string"))).alias("items"))


PRIORITIES = """p AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderpriority <> '5-LOW')) AS items
  FROM orders GROUP BY 1)"""


@query(f"""
WITH {PRIORITIES} SELECT o_custkey, '__list__["' || array_to_string(items, '","') || '",null]' AS items FROM p""")
def tagged_list_encode(t):
    return priority_lists(t).select("o_custkey", lists.tag_encode(F.col("items")).alias("items"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority || '|x' WHEN 'O' THEN '__list__["' || o_orderpriority ELSE o_orderpriority END AS items,
  CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS n FROM orders""")
def tagged_list_decode(t):
    status, name = F.col("o_orderstatus"), F.col("o_orderpriority")
    shown = (F.when(status == "F", lists.tag_encode(F.array(name, F.lit("x"))))
             .when(status == "O", F.concat(F.lit('__list__["'), name)).otherwise(name))
    items = lists.tag_decode(shown)
    return t.orders.select("o_orderkey", joined(items).alias("items"), F.size(items).alias("n"))


@query(f"""
WITH {PRIORITIES} SELECT o_custkey, array_to_string(items, ', ') || ', null' AS items FROM p""")
def export_csv(t):
    path = t.scratch("export")
    files.write_csv(priority_lists(t), path)
    return files.read_csv(t.spark, path, "o_custkey long, items string")


@query("""
SELECT user_id::VARCHAR AS id, event_type AS title, event_id // 50 AS page FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def paged_listing_dedup(t):
    """Events as listing pages of 50 records; a user listed again replaces itself."""
    number = F.expr("event_id div 50")
    record = F.struct(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("title"), number.alias("page"))
    data = F.transform(F.sort_array(F.collect_list(F.struct("event_id", record.alias("r")))), lambda e: e["r"])
    pages = t.events.groupBy(number.alias("n")).agg(data.alias("data")).select(
        F.to_json(F.struct(F.struct(F.col("n").alias("currentPage")).alias("pagination"), "data")).alias("body"))
    schema = "struct<pagination:struct<currentPage:bigint>,data:array<struct<id:string,title:string,page:bigint>>>"
    return listings.last_page_wins(pages, "body", schema, "id", "pagination.currentPage")


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_type = 'view' THEN user_id END AS "user", NULL::VARCHAR AS missing FROM events""")
def json_fields(t):
    nested = F.when(F.col("event_type") == "view", F.struct(F.struct(F.col("user_id").alias("id")).alias("who")))
    document = F.to_json(F.struct(F.from_json("props", "k string").alias("props"), nested.alias("actor")))
    schema = "struct<props:struct<k:string>,actor:struct<who:struct<id:bigint>>,other:struct<deep:struct<x:string>>>"
    fields = listings.pick_fields(document, schema, {"k": "props.k", "user": "actor.who.id", "missing": "other.deep.x"})
    return t.events.select("event_id", *[c.alias(n) for n, c in fields.items()])


@query(r"""
SELECT page_id, regexp_extract(html, '(?is)<title>([^<]*)</title>', 1) AS title,
  array_to_string(regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>([^<]*)</a>', 1), '|') AS items,
  array_to_string(regexp_extract_all(html, '(?is)<meta\b[^>]*\bcharset="([^"]*)"', 1), '|') AS charset,
  regexp_extract(html, '(?is)<h1>([^<]*)</h1>', 1) AS headline FROM pages""")
def html_label_values(t):
    page = F.col("html")
    return t.pages.select(
        "page_id", F.get(html.tag_texts(page, "title"), F.lit(0)).alias("title"),
        joined(html.tag_texts(page, "a")).alias("items"), joined(html.meta_values(page, "charset")).alias("charset"),
        F.get(html.tag_texts(page, "h1"), F.lit(0)).alias("headline"))


@query(r"""
WITH a AS (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1) AS found FROM pages),
h AS (SELECT page_id, url, unnest(found) AS href, unnest(range(len(found)))::INTEGER AS place FROM a)
SELECT page_id, url, place, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^[^:]+://[^/?#]*') || href ELSE href END AS link FROM h""")
def page_links(t):
    return html.links(t.pages, "html", "url")


@query("SELECT p_partkey, p_name AS title, p_brand AS substance, CASE WHEN p_size > 25 THEN p_type END AS decision FROM part")
def header_map(t):
    cells = F.when(F.col("p_size") > 25, F.array("p_name", "p_brand", "p_type")).otherwise(F.array("p_name", "p_brand"))
    df = t.part.select("p_partkey", F.array(F.lit("Name"), F.lit("INN"), F.lit("Decision")).alias("headers"), cells.alias("cells"))
    return listings.header_map(df, "headers", "cells", ["title", "substance", "decision"])


@query(" UNION ALL ".join(f"SELECT '{n}' AS source, count(*) AS total_records, true AS dated FROM {n}" for n in TABLES))
def source_inventory(t):
    found = files.inventory(t.spark, {n: t.path(n) for n in TABLES})
    return found.select("source", "total_records", F.col("last_update").isNotNull().alias("dated"))


@query("""
SELECT 'orders' AS source, count(*) AS items, count(*) FILTER (o_totalprice > 400000) AS errors, 'finished' AS reason, true AS timed FROM orders
UNION ALL SELECT 'broken', NULL, NULL, 'failed', true""")
def run_report(t):
    """Two runs in the table of runs; the second cannot write its rows."""
    root, runs = t.scratch("landing"), t.scratch("runs")
    files.append_run(files.land_with_report(t.orders, root, "orders", F.col("o_totalprice") > 400000), runs)
    broken = t.orders.withColumn("bad", F.raise_error(F.lit("bad record")))
    files.append_run(files.land_with_report(broken, root, "broken", F.col("o_totalprice") > 400000), runs)
    timed = F.col("started").isNotNull() & (F.col("seconds") >= 0)
    return files.read_parquet(t.spark, runs).select(
        "source", "items", "errors", F.split("reason", ":")[0].alias("reason"), timed.alias("timed"))
