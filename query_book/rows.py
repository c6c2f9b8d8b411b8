"""Choosing columns and rows."""

from pyspark.sql import functions as F

from query_book import joined, query
from trialweave.operators import columns, filters
from trialweave.plans import search


def sparse_orders(t):
    """Orders with nulls: no status P, no prices up to 100000, one column without any value."""
    return t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("o_totalprice"), F.lit(None).cast("string").alias("empty"),
    )


SPARSE = """sparse AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
  CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS o_totalprice FROM orders)"""


@query("SELECT p_name, p_size FROM part")
def select_available(t):
    return columns.select_available(t.part, ["p_name", "p_container", "p_size"])


@query("SELECT p_partkey AS id, p_name AS title, p_brand FROM part")
def rename_columns(t):
    return columns.rename(t.part.select("p_partkey", "p_name", "p_brand"),
                          {"p_partkey": "id", "p_name": "title", "p_none": "none"})


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def drop_columns(t):
    return columns.drop_columns(t.orders, ["o_custkey", "o_orderstatus", "o_orderdate", "o_none"])


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem")
def drop_by_prefix(t):
    return columns.drop_by_prefix(t.lineitem, "l_line", "l_ship")


# Decimals, so both engines round the same exact products.
@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_extendedprice::DECIMAL(12, 2) AS price, l_discount::DECIMAL(4, 2) AS discount,
                  l_tax::DECIMAL(4, 2) AS tax FROM lineitem)
SELECT l_orderkey, l_linenumber, (price * (1 - discount))::DOUBLE AS net, (price * (1 - discount) * (1 + tax))::DOUBLE AS gross,
       price * (1 - discount) * (1 + tax) > 50000 AS is_large FROM d""")
def assign_chain(t):
    df = columns.assign(
        t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                          F.col("l_discount").cast("decimal(4,2)").alias("discount"),
                          F.col("l_tax").cast("decimal(4,2)").alias("tax")),
        {"net": F.col("price") * (1 - F.col("discount"))},
        {"gross": F.col("net") * (1 + F.col("tax"))},
        {"is_large": F.col("gross") > 50000},
    )
    return df.select("l_orderkey", "l_linenumber", F.col("net").cast("double").alias("net"),
                     F.col("gross").cast("double").alias("gross"), "is_large")


@query(f"WITH {SPARSE} SELECT o_orderstatus, o_totalprice FROM sparse WHERE o_orderstatus IS NOT NULL OR o_totalprice IS NOT NULL")
def drop_null_rows(t):
    return columns.drop_null_rows(sparse_orders(t).select("o_orderstatus", "o_totalprice"))


@query(f"WITH {SPARSE} SELECT o_orderkey, o_orderstatus, o_totalprice FROM sparse")
def drop_null_columns(t):
    return columns.drop_null_columns(sparse_orders(t))


@query(f"WITH {SPARSE} SELECT o_orderkey, o_orderstatus, o_totalprice FROM sparse WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL")
def dropna_subset(t):
    return columns.dropna_subset(sparse_orders(t), ["o_orderstatus", "o_totalprice"]).drop("empty")


@query("SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0 AND nullif(c_mktsegment, 'MACHINERY') IS NOT NULL")
def filter_values(t):
    known = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    return t.customer.where(filters.positive_and_known(F.col("c_acctbal"), known)).select(
        "c_custkey", "c_acctbal", "c_mktsegment")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_isin(t):
    return t.orders.where(filters.is_in(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])).select(
        "o_orderkey", "o_orderpriority")


@query("SELECT p_partkey, p_type FROM part WHERE lower(p_type) IN ('promo', 'small')")
def filter_isin_ci(t):
    return t.part.where(filters.is_in_ignoring_case(F.col("p_type"), ["Promo", "SMALL"])).select("p_partkey", "p_type")


@query("""
SELECT o_orderkey FROM orders
WHERE coalesce((nullif(o_orderstatus, 'P') = 'F') = true, false) AND coalesce((o_totalprice > 200000) = false, false)""")
def filter_flags(t):
    finished = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F"
    return filters.where_all(t.orders, [
        filters.flag_choice(finished, True), filters.flag_choice(F.col("o_totalprice") > 200000, False),
        filters.flag_choice(F.col("o_totalprice") > 100, None),
    ]).select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def filter_contains(t):
    return t.part.where(filters.contains(F.col("p_name"), "ring")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(nullif(p_type, 'PROMO')), '^s.*l') OR regexp_matches(lower(p_name), 'ring')")
def filter_pattern_ci(t):
    kind = F.nullif("p_type", F.lit("PROMO"))
    return t.part.where(filters.matches(kind, "^s.*L") | filters.matches(F.col("p_name"), "RING", literal=True)).select(
        "p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE list_has_any(string_split(p_name, ' '), ['red', 'widget'])")
def array_any_exact(t):
    words = F.transform(F.split("p_name", " "), lambda w: F.concat(F.lit(" "), F.upper(w)))
    return t.part.where(filters.any_item_equals(words, ["red", "widget"])).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE len(list_filter(string_split(p_name, ' '), lambda x: contains(x, 'ol'))) > 0")
def array_any_substring(t):
    return t.part.where(filters.any_item_contains(F.split("p_name", " "), "OL")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'd bo')")
def cell_text_contains(t):
    return t.part.where(filters.cell_contains(F.split("p_name", " "), "D bo", is_array=True)).select("p_partkey", "p_name")


@query(r"""
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_acctbal > 5000
             THEN '2' || substr(c_name, length(c_name) - 2, 3) || '-' || substr(c_name, length(c_name) - 5, 6) || '-00'
             ELSE c_name END AS id_value FROM customer)
SELECT c_custkey, id_value FROM c WHERE regexp_matches(id_value, '^\d{4}-\d{6}-.*$') OR id_value IS NULL""")
def id_pattern_filter(t):
    name = F.col("c_name")
    number = F.concat(F.lit("2"), F.right(name, F.lit(3)), F.lit("-"), F.right(name, F.lit(6)), F.lit("-00"))
    value = F.when(F.col("c_mktsegment") == "MACHINERY", None).when(F.col("c_acctbal") > 5000, number).otherwise(name)
    df = t.customer.select("c_custkey", value.alias("id_value"))
    return df.where(filters.matches_or_missing(F.col("id_value"), r"^\d{4}-\d{6}-.*$"))


@query(f"WITH {SPARSE} SELECT o_orderkey FROM sparse WHERE o_orderstatus IS NOT NULL OR o_totalprice IS NOT NULL")
def has_any(t):
    return sparse_orders(t).where(filters.any_known(F.col("o_orderstatus"), F.col("o_totalprice"))).select("o_orderkey")


@query("SELECT event_id, value FROM events WHERE value > 20.5")
def score_cutoff(t):
    return t.events.where(filters.above(F.col("value"), 20.5)).select("event_id", "value")


@query("""
SELECT s_name AS title, s_acctbal AS enrollment, NULL::VARCHAR AS condition, 'supplier' AS source_dataset FROM supplier""")
def align_schema(t):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("title string, enrollment double, condition string, source_dataset string")
    df = columns.rename(t.supplier, {"s_name": "title", "s_acctbal": "enrollment"})
    return columns.align_schema(df, schema, {"source_dataset": "supplier"})


def order_studies(t):
    """Orders as studies: lines give the interventions, dates and states the rest."""
    from trialweave.operators.aggregates import distinct_lists
    sides = distinct_lists(
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["l_orderkey"],
        {"interventions": "p_name", "therapeutic_area": "p_type", "keywords": "p_brand"})
    return t.orders.join(sides, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderdate").alias("start_date"), "therapeutic_area", "interventions", "keywords",
        F.col("o_orderpriority").alias("study_type"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        (F.col("o_totalprice") > 150000).alias("Gender_F"), (F.col("o_totalprice") <= 150000).alias("Gender_M"), (F.col("o_totalprice") > 60000).alias("Age_18_64_years"),
    )


@query("""
WITH s AS (SELECT l_orderkey, list_sort(list_distinct(list(p_name))) AS i, list_distinct(list(p_type)) AS a,
                  list_distinct(list(p_brand)) AS k FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT 'Order ' || o_orderkey AS title, o_orderdate AS start_date, array_to_string(i, '|') AS interventions,
       o_orderpriority AS study_type, o_orderstatus AS status
FROM orders JOIN s ON o_orderkey = l_orderkey
WHERE o_totalprice > 150000 AND o_totalprice > 60000 AND o_orderstatus = 'F' AND lower(o_orderpriority) = '1-urgent'
  AND len(list_filter(i, lambda x: contains(x, 'ring'))) > 0 AND len(list_filter(a, lambda x: contains(lower(x), 'promo'))) > 0
  AND len(list_filter(k, lambda x: contains(lower(x), 'brand#1'))) > 0""")
def faceted_search(t):
    found = search.faceted_search(
        order_studies(t), age="18-64 years", sex="Female", condition="Promo", intervention="RING",
        keyword="brand#1", outcome="survival", study_type="1-urgent", status="f")
    return search.details(found, "title").select(
        "title", "start_date", joined(F.col("interventions")).alias("interventions"), "study_type", "status")
