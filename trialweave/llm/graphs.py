"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.session import stage


def _least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least neighbour of u as ``m``. Minima are combined per task before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it is connected to, for every node but the least ones themselves.

    ``edges`` has the columns a and b; loops, repeats and nulls are ignored. Large-star and small-star rounds alternate: each
    links neighbours to the least node nearby, the edges never become more, and the rounds grow with the logarithm of the
    nodes. Every round is written to the shared folder.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def mark(df: DataFrame):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").bitwiseAND((1 << 40) - 1)).alias("s")).first()
        return r["n"], r["s"]

    was = mark(now)
    while was[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        small = _least(large)
        linked = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = stage(linked.distinct(), "edges")
        is_ = mark(now)
        if is_ == was:
            break
        was = is_
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
