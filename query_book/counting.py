"""Aggregates and profiles."""

from pyspark.sql import functions as F

from query_book import joined, query
from query_book.rows import SPARSE, sparse_orders
from trialweave.functions.values import holds
from trialweave.operators import aggregates, columns, filters, profile


@query("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), '|') AS flags FROM lineitem GROUP BY 1")
def distinct_list_per_key(t):
    df = aggregates.distinct_lists(t.lineitem, ["l_orderkey"], {"flags": "l_returnflag"})
    return df.select("l_orderkey", joined(F.col("flags")).alias("flags"))


@query("SELECT count(*) AS n, count(*) FILTER (l_returnflag IN ('A', 'R')) AS returned FROM lineitem")
def count_rows(t):
    returned = filters.is_in(F.col("l_returnflag"), ["A", "R"])
    return t.lineitem.agg(F.count("*").alias("n"), F.count_if(returned).alias("returned"))


@query(f"""
WITH {SPARSE} SELECT sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS total, count(*) FILTER (o_orderstatus = 'F') AS finished,
  sum((o_orderstatus = 'O')::BIGINT)::BIGINT AS open FROM sparse""")
def kpi_sums(t):
    return sparse_orders(t).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.count_if(holds(F.col("o_orderstatus") == "F")).alias("finished"),
        F.sum((F.col("o_orderstatus") == "O").cast("bigint")).alias("open"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL GROUP BY 1")
def value_counts(t):
    df = t.orders.select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return aggregates.value_counts(df, "o_orderpriority")


@query(f"WITH {SPARSE} SELECT round(avg((o_orderstatus = 'F')::INTEGER), 9) AS share FROM sparse WHERE o_orderstatus IS NOT NULL")
def value_share(t):
    return aggregates.value_share(sparse_orders(t), "o_orderstatus", "F").select(F.round("share", 9).alias("share"))


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def count_by_year(t):
    return aggregates.count_by_year(t.orders, "o_orderdate")


@query("SELECT item, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS item FROM part) WHERE item <> 'red' GROUP BY 1")
def exploded_counts(t):
    words = F.transform(F.split("p_name", " "), lambda w: F.nullif(w, F.lit("red")))
    return aggregates.exploded_counts(t.part.select(words.alias("words")), F.col("words"))


@query("""
SELECT 'Returned' AS label, count(*) FILTER (l_returnflag = 'R') AS total FROM lineitem
UNION ALL SELECT 'Open', count(*) FILTER (l_linestatus = 'O') FROM lineitem
UNION ALL SELECT 'Never', 0 FROM (SELECT count(*) FROM lineitem)""")
def flag_totals(t):
    df = t.lineitem.select((F.col("l_returnflag") == "R").alias("r"), (F.col("l_linestatus") == "O").alias("o"),
                           (F.col("l_quantity") < 0).alias("never"))
    return aggregates.flag_totals(df, {"Returned": "r", "Open": "o", "Never": "never", "Absent": "absent"})


@query(f"""
WITH {SPARSE} SELECT CASE WHEN o_orderstatus IS NOT NULL OR o_totalprice IS NOT NULL THEN 'Has criteria' ELSE 'No criteria' END AS label,
  count(*) AS n FROM sparse GROUP BY 1""")
def has_criteria_counts(t):
    known = filters.any_known(F.col("o_orderstatus"), F.col("o_totalprice"))
    return aggregates.labelled_counts(sparse_orders(t), known, "Has criteria", "No criteria")


@query("""
WITH x AS (SELECT o_custkey, unnest(string_split(o_orderpriority || ', ' || o_orderstatus, ', ')) AS item FROM orders WHERE o_orderstatus <> 'P')
SELECT o_custkey, array_to_string(list_sort(list_distinct(list(item))), ', ') AS types FROM x GROUP BY 1""")
def merge_lists_per_key(t):
    types = F.when(F.col("o_orderstatus") != "P", F.concat_ws(", ", "o_orderpriority", "o_orderstatus"))
    return aggregates.merge_lists(t.orders.select("o_custkey", types.alias("types")), "o_custkey", "types")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def dedup_keep_first(t):
    df = aggregates.dedup_keep_first(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return df.select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_all(t):
    return aggregates.dedup_all(t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(f"""
WITH {SPARSE} SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS nulls FROM sparse
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM sparse
UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM sparse
UNION ALL SELECT 'empty', count(*) FROM sparse""")
def null_profile(t):
    return profile.null_profile(sparse_orders(t))


@query(f"""
WITH {SPARSE} SELECT 0 AS position, 'o_orderkey' AS "column", 'bigint' AS type, count(o_orderkey) AS known FROM sparse
UNION ALL SELECT 1, 'o_orderstatus', 'string', count(o_orderstatus) FROM sparse
UNION ALL SELECT 2, 'o_totalprice', 'double', count(o_totalprice) FROM sparse
UNION ALL SELECT 3, 'empty', 'string', 0 FROM (SELECT count(*) FROM sparse)""")
def column_info(t):
    return profile.column_info(sparse_orders(t))


def _described(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean,
  round(stddev_samp({column}), 6) AS std, min({column})::DOUBLE AS "min", round(quantile_cont({column}::DOUBLE, 0.25), 6) AS q25,
  round(quantile_cont({column}::DOUBLE, 0.5), 6) AS q50, round(quantile_cont({column}::DOUBLE, 0.75), 6) AS q75,
  max({column})::DOUBLE AS "max" FROM {source}"""


@query(" UNION ALL ".join(_described(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_linenumber")))
def describe_numeric(t):
    df = profile.describe_numeric(t.lineitem, ["l_quantity", "l_extendedprice", "l_linenumber"])
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO'")
def distinct_options(t):
    return aggregates.distinct_options(t.part.select(F.nullif("p_type", F.lit("PROMO")).alias("p_type")), "p_type")


@query("""SELECT DISTINCT lower(unnest([p_name, p_type])) AS "option" FROM part""")
def list_options(t):
    items = F.array(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  "))), F.col("p_type"), F.lit(None))
    return aggregates.list_options(t.part.select(items.alias("items")), "items")


@query("""
SELECT c_mktsegment, """ + ", ".join(f'count(*) FILTER (c_nationkey = {i}) AS "{i}"' for i in range(25)) + """ FROM customer GROUP BY 1""")
def pivot_counts(t):
    df = t.customer.withColumn("nation", F.col("c_nationkey").cast("string"))
    return aggregates.pivot_counts(df, ["c_mktsegment"], "nation", [str(i) for i in range(25)])


@query("""
SELECT o_orderkey, coalesce(x = 'F', false) AS "status_F", coalesce(x = 'O', false) AS "status_O"
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS x FROM orders)""")
def pivot_indicators(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("s"))
    return columns.category_indicators(df, "s", prefix="status").drop("s")
