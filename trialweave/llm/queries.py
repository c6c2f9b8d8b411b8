"""The operators of this package as queries on the driver tables, beside the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialweave.llm import benchmarks, mixing, negatives, neighbours, pages, repeats, sharding, simhash, surrogates, topk, toxicity, turns, urls
from trialweave.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# For the check only; a user brings a secret of their own.
SURROGATE_KEY = "example key"
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def query(sql: str | None = None):
    """Register a function of session and folder under its own name."""
    def register(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(tune(spark), folder)
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_sharding(spark, folder):
    return sharding.shard_layout(table(spark, folder, "documents"), 40)


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op2_topk(spark, folder):
    vectors = topk.integer_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def url_sql() -> str:
    """The URL filter in SQL: rules, then level by level the branches kept, then the purity of templates."""
    ordered = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(kind, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for kind, h, p in ordered]
    names = " ".join(f"WHEN {c} THEN '{n}'" for _, n, c in fits)
    kinds = " ".join(f"WHEN {c} THEN '{k}'" for k, _, c in fits)
    steps = [f"""a0 AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
a1 AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM a0),
a2 AS (SELECT *, CASE {names} END AS rule, CASE {kinds} END AS ruled, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM a1),
r0 AS (SELECT *, {", ".join(f"coalesce(regexp_replace(parts[{i}], '[0-9]+', '#', 'g'), '') AS s{i}" for i in (1, 2, 3))} FROM a2)"""]
    above = ["host"]
    for i in (1, 2, 3):
        up = ", ".join(above)
        steps.append(f"""b{i} AS (SELECT {up}, s{i}, count(ruled) AS lab, count(*) FILTER (ruled = 'block') AS blk FROM r{i - 1} GROUP BY {up}, s{i}),
k{i} AS (SELECT {up}, s{i} FROM (SELECT *, (sum(blk) OVER (PARTITION BY {up}) + 1) / (sum(lab) OVER (PARTITION BY {up}) + 2) AS p FROM b{i})
  WHERE s{i} <> '' AND NOT contains(s{i}, '#') AND abs(blk - lab * p) > 1 + {urls.Z} * sqrt(lab * p * (1 - p))),
r{i} AS (SELECT r.*, CASE WHEN k.host IS NOT NULL THEN r.s{i} WHEN r.s{i} = '' THEN '' ELSE '*' END AS t{i} FROM r{i - 1} r
  LEFT JOIN k{i} k ON {" AND ".join(f"r.{c} = k.{c}" for c in [*above, f"s{i}"])})""")
        above.append(f"t{i}")
    up = ", ".join(above)
    steps.append(f"""p AS (SELECT *, (sum(lab) OVER (PARTITION BY host) + {urls.STRENGTH}) AS hl, (sum(blk) OVER (PARTITION BY host) + {urls.STRENGTH * urls.PRIOR}) AS hb
  FROM (SELECT {up}, count(ruled) AS lab, count(*) FILTER (ruled = 'block') AS blk FROM r3 GROUP BY {up})),
q AS (SELECT {up}, round((blk + {urls.STRENGTH} * (hb / hl)) / (lab + {urls.STRENGTH}), 9) AS purity FROM p)""")
    shape = " || ".join(f"CASE WHEN t{i} = '' THEN '' ELSE '/' || t{i} END" for i in (1, 2, 3))
    return "WITH " + ",\n".join(steps) + f"""
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity > {urls.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict, {shape} AS template, purity
FROM r3 JOIN q USING ({up})"""


@query(url_sql())
def op3_urls(spark, folder):
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@query()
def op4_simhash(spark, folder):
    return simhash.fingerprint_classes(table(spark, folder, "documents"))


@query()
def op5_repeats(spark, folder):
    return repeats.remove_repeats(table(spark, folder, "documents"))


@query()
def op6_leaks(spark, folder):
    return benchmarks.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op7_surrogates(spark, folder):
    return surrogates.replace_entities(table(spark, folder, "documents"), SURROGATE_KEY)


@query()
def op8_mixing(spark, folder):
    return mixing.schedule(table(spark, folder, "documents"))


@query()
def op9_main_text(spark, folder):
    return pages.main_texts(table(spark, folder, "pages"))


@query()
def op10_toxicity(spark, folder):
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("""
WITH v AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op11_negatives(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 100 == 0)


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""")
def op12_neighbours(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)


def damaged(conversations: DataFrame) -> DataFrame:
    """One row in five is dropped, emptied, robbed of its full stops, repeated or given to the user, by the hash of its place."""
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    hit = F.crc32(F.concat(known["conv_id"], F.lit(":"), known["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", known["role"].alias("role"), known["text"].alias("text"), hit.alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return rows.where(F.col("hit") != 0).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("time"))


@query()
def op13_repair(spark, folder):
    conversations = table(spark, folder, "conversations")
    edits, summary = turns.repair(damaged(conversations))
    found = summary.join(turns.repaired_digests(edits), "k").drop("k").withColumnRenamed("conv_id", "id")
    whole = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
