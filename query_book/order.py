"""Order, samples, chunks."""

from pyspark.sql import functions as F

from query_book import query
from trialweave.functions.text import labelled_line
from trialweave.operators import aggregates, ordering


@query("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s FROM orders ORDER BY s DESC NULLS LAST, o_orderkey")
def sort_nulls_last(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("s"))
    return ordering.sort_nulls_last(df, "s", True, "o_orderkey")


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_name LIMIT 10")
def top_k_values(t):
    return aggregates.value_counts(t.part, "p_name").limit(10)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 25")
def most_recent_n(t):
    return ordering.most_recent(t.orders, "o_orderdate", 25, "o_orderkey").select("o_orderkey", "o_orderdate")


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey::VARCHAR || ':123'), c_custkey LIMIT 50")
def seeded_sample(t):
    return ordering.seeded_sample(t.customer.select("c_custkey", "c_name"), "c_custkey", 50)


@query("""
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) - 1 AS ordinal, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, ordinal, ordinal // 400 AS chunk FROM o WHERE ordinal // 400 < ceil(ceil(n / 400) * 0.5)""")
def chunk_rows(t):
    order = [F.desc_nulls_last("o_orderdate"), F.col("o_orderkey")]
    return ordering.chunk_rows(t.orders.select("o_orderkey", "o_orderdate"), order, 400, 0.5).drop("o_orderdate")


@query("""
WITH o AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR || ':123'), o_orderkey) - 1 AS ordinal FROM orders)
SELECT ordinal // 500 AS chunk, 'Trials:' || chr(10) || string_agg('- id: ' || o_orderkey || ', Title: ' || o_orderpriority, chr(10) ORDER BY ordinal)
  || chr(10) AS context FROM o GROUP BY 1""")
def chunk_context(t):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    chunks = ordering.chunk_rows(df, ordering.sample_order("o_orderkey"), 500)
    line = labelled_line([("id", F.col("o_orderkey")), ("Title", F.col("o_orderpriority"))])
    return ordering.chunk_context(chunks, line, "Trials:")
