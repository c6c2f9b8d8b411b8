"""Joins and stacked frames."""

from pyspark.sql import functions as F

from query_book import day, joined, query
from trialweave.functions.values import to_day
from trialweave.operators import aggregates, joins, sets


def customer_nations(t):
    """Countries of a customer: nation 0 to 4 customers also count for the next nation."""
    home = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), (F.col("c_acctbal") < 0).alias("removed"))
    second = home.where("n_nationkey < 5").withColumn("n_nationkey", F.col("n_nationkey") + 1)
    return home.unionByName(second).join(t.nation, "n_nationkey").where("n_name IN ('NATION_3', 'NATION_4') AND NOT removed")


NATIONS = """links AS (SELECT c_custkey FROM (SELECT c_custkey, c_nationkey AS k, c_acctbal < 0 AS removed FROM customer
  UNION ALL SELECT c_custkey, c_nationkey + 1, c_acctbal < 0 FROM customer WHERE c_nationkey < 5)
  JOIN nation ON k = n_nationkey WHERE n_name IN ('NATION_3', 'NATION_4') AND NOT removed)"""


@query(f"WITH {NATIONS} SELECT c_custkey, c_name FROM customer JOIN links USING (c_custkey)")
def join_country_filter(t):
    return joins.filter_by_link(t.customer.select("c_custkey", "c_name"), customer_nations(t), "c_custkey")


@query(f"WITH {NATIONS} SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT c_custkey FROM links)")
def join_country_semi(t):
    return joins.filter_by_link(t.customer.select("c_custkey", "c_name"), customer_nations(t), "c_custkey", semi=True)


@query("""
SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(p_name))), '|') AS terms,
       array_to_string(list_sort(list_distinct(list(p_brand))), '|') AS grouping
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def join_dict_agg(t):
    df = joins.lists_through_dictionary(t.lineitem, t.part, "l_orderkey", "l_partkey", "p_partkey",
                                        {"terms": "p_name", "grouping": "p_brand"})
    return df.select("l_orderkey", joined(F.col("terms")).alias("terms"), joined(F.col("grouping")).alias("grouping"))


@query("""
WITH flags AS (SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), '|') AS flags FROM lineitem GROUP BY 1),
lines AS (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1),
late AS (SELECT l_orderkey, count(*) AS late_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate GROUP BY 1)
SELECT o_orderkey, o_orderstatus, flags, lines, quantity, late_lines FROM orders
LEFT JOIN flags f ON f.l_orderkey = o_orderkey LEFT JOIN lines n ON n.l_orderkey = o_orderkey
LEFT JOIN late x ON x.l_orderkey = o_orderkey""")
def star_left_join(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    flags = aggregates.distinct_lists(lines, ["o_orderkey"], {"flags": "l_returnflag"})
    totals = lines.groupBy("o_orderkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    late = (lines.join(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey").where("l_shipdate > o_orderdate")
            .groupBy("o_orderkey").agg(F.count("*").alias("late_lines")))
    return joins.star_left(orders, [flags, totals, late], "o_orderkey").withColumn("flags", joined(F.col("flags")))


def two_registers(t):
    """Orders split into two overlapping registers; a null key stands for a missing number."""
    number = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("number")
    left = t.orders.where(F.col("o_totalprice") > 150000).select(
        number, F.col("o_orderpriority").alias("title"), F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")).alias("size"),
        F.col("o_custkey").alias("left_id"))
    right = t.orders.where(F.col("o_totalprice") < 350000).select(
        number, F.concat(F.lit("R "), "o_orderpriority").alias("title"), (-F.col("o_totalprice")).alias("size"),
        F.col("o_custkey").alias("right_id"))
    return left, right


REGISTERS = """l AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS number, o_orderpriority AS title,
  CASE WHEN o_totalprice > 300000 THEN o_totalprice END AS size, o_custkey AS left_id FROM orders WHERE o_totalprice > 150000),
r AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS number, 'R ' || o_orderpriority AS title,
  -o_totalprice AS size, o_custkey AS right_id FROM orders WHERE o_totalprice < 350000)"""


@query(f"""
WITH {REGISTERS} SELECT coalesce(l.number, r.number) AS number, coalesce(r.title, l.title) AS title,
  coalesce(l.size, r.size) AS size, left_id, right_id FROM l FULL OUTER JOIN r ON l.number = r.number""")
def full_outer_coalesce(t):
    left, right = two_registers(t)
    return joins.full_outer_coalesce(left, right, "number", prefer_right=["title"])


# Null keys match each other here, so the sides are first reduced to one row per key.
@query("""
WITH l AS (SELECT CASE WHEN c_acctbal > 0 THEN c_nationkey END AS number, count(*) AS n FROM customer GROUP BY 1),
r AS (SELECT CASE WHEN s_acctbal > 5000 THEN s_nationkey END AS number, count(*) AS m FROM supplier GROUP BY 1)
SELECT coalesce(l.number, r.number) AS number, n, m FROM l FULL OUTER JOIN r ON l.number IS NOT DISTINCT FROM r.number""")
def full_outer_nullsafe(t):
    left = t.customer.groupBy(F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("number")).agg(F.count("*").alias("n"))
    right = t.supplier.groupBy(F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey")).alias("number")).agg(F.count("*").alias("m"))
    return joins.full_outer_coalesce(left, right, "number", null_keys_match=True)


@query("SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_left_right_on(t):
    return joins.join_on_pairs(t.orders.select("o_orderkey", "o_custkey"), t.customer.select("c_custkey", "c_name"),
                               {"o_custkey": "c_custkey"})


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END AS code,
       nullif(n_name, 'NATION_7') AS nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def map_lookup(t):
    coded = joins.map_lookup(t.customer, "c_mktsegment", {"BUILDING": "B", "MACHINERY": "M"}, "code")
    nations = t.nation.where("n_name <> 'NATION_7'").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    return joins.map_lookup(coded, "c_nationkey", nations, "nation").select("c_custkey", "code", "nation")


@query("""
SELECT event_id AS place, o_orderkey, o_orderpriority FROM events JOIN orders ON user_id = o_orderkey""")
def rows_by_ids(t):
    ids = t.events.select(F.col("user_id").alias("o_orderkey"), F.col("event_id").alias("place"))
    return joins.rows_by_ids(ids, t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", "place")


@query("""
SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_acctbal FROM supplier""")
def union_by_name(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return sets.union_by_name(a, b)


@query("""
SELECT o_orderkey::VARCHAR AS id, strftime(o_orderdate, '%Y-%m-%d') AS start_date, NULL::DOUBLE AS value, 'orders' AS source FROM orders
UNION ALL SELECT event_type, NULL, value, 'events' FROM events""")
def stack_sources(t):
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"))
    b = t.events.select(F.col("event_type").alias("id"), F.col("event_type").alias("start_date"), "value")
    df = sets.stack_sources({"orders": a, "events": b}, dates=["start_date"], to_date=to_day)
    return df.withColumn("start_date", day(F.col("start_date")))
