"""Mixing sources to target weights by Pfair scheduling.

Blocks of a source are unit jobs. Block j of a source with share w has the release time floor(j / w) and the
deadline ceil((j + 1) / w); at each step the released block with the earliest deadline goes next. On one line of
steps this keeps every source less than one block from its share at every prefix.

Shares are the exact ratios of the weights, so the bound holds over any number of steps. The schedule is written by one task that
holds a row per source and reads no rows, one step per block, and Spark joins every block to its step. When a source runs out, the others
go on from there with their shares scaled up. With a ``period`` D given, shares are rounded to whole parts a / D first, as a
schedule that repeats every D steps has them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.common import numbered_columns
from trialweave.session import stage

BLOCK_ROWS = 32
SALTS = 64
# About so many rows share a broadcast row of ``steps_by_hash``; tables of more rows than the other are joined to their steps instead.
CELL_ROWS = 4096
MOST_BROADCAST = 50_000_000


def whole_parts(weights: Mapping[int, float], period: int) -> dict[int, int]:
    """Shares in whole parts of the period, at least one each, by largest remainder."""
    total = sum(Fraction(w) for w in weights.values())
    exact = {k: Fraction(w) * period / total for k, w in weights.items()}
    parts = {k: max(1, math.floor(x)) for k, x in exact.items()}
    order = sorted(exact, key=lambda k: (parts[k] - exact[k], k))
    while (short := period - sum(parts.values())) > 0:
        for k in order[:short]:
            parts[k] += 1
    while sum(parts.values()) > period:
        k = max((k for k in parts if parts[k] > 1), key=lambda k: (parts[k] - exact[k], k))
        parts[k] -= 1
    return parts


def one_period(parts: Mapping[int, int]) -> list[int]:
    """The source of each step: earliest deadline first among released blocks, ties to the smaller key."""
    period = sum(parts.values())
    done = dict.fromkeys(parts, 0)
    steps = []
    for step in range(period):
        released = [k for k in parts if done[k] < parts[k] and done[k] * period // parts[k] <= step]
        k = min(released, key=lambda k: (-(-(done[k] + 1) * period // parts[k]), k))
        done[k] += 1
        steps.append(k)
    return steps


def steps_of(blocks: Mapping[int, int], weights: Mapping[int, float], period: int | None = None) -> Iterator[tuple[int, int]]:
    """(source, block) of every step: earliest deadline first among released blocks, ties to the smaller key."""
    left = {k: n for k, n in blocks.items() if n > 0}
    used = dict.fromkeys(left, 0)
    while left:
        # What has no weight comes last.
        now = {k: weights[k] for k in left if weights[k] > 0} or dict.fromkeys(left, 1)
        if period:
            parts = whole_parts(now, max(period, 2 * len(now)))
        else:
            # Floats are exact ratios; over a common denominator all that follows is whole numbers.
            exact = {k: Fraction(w) for k, w in now.items()}
            common = math.lcm(*(x.denominator for x in exact.values()))
            parts = {k: x.numerator * (common // x.denominator) for k, x in exact.items()}
        total = sum(parts.values())
        done = dict.fromkeys(now, 0)
        ready = [(-(-total // parts[k]), k) for k in now]
        heapq.heapify(ready)
        waiting: list[tuple[int, int]] = []
        step = 0
        while True:
            while waiting and waiting[0][0] <= step:
                k = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-(-(done[k] + 1) * total // parts[k]), k))
            k = heapq.heappop(ready)[1]
            yield k, used[k]
            used[k] += 1
            done[k] += 1
            left[k] -= 1
            step += 1
            if not left[k]:
                del left[k]
                break
            heapq.heappush(waiting, (done[k] * total // parts[k], k))


def laid_out(spark: SparkSession, names: list, blocks: Mapping[int, int], weights: Mapping[int, float], period: int | None) -> DataFrame:
    """``__s``, ``__b`` and ``__step`` for every block, written by one task as it goes."""
    def run(batches):
        from itertools import islice

        import numpy as np
        import pandas as pd

        for pdf in batches:
            if not len(pdf):
                continue
            steps, start = steps_of(blocks, weights, period), 0
            while part := list(islice(steps, 100_000)):
                k, b = zip(*part)
                yield pd.DataFrame({"__n": np.array(k, np.int64), "__b": np.array(b, np.int64), "__step": np.arange(start, start + len(part))})
                start += len(part)

    plan = stage(spark.range(0, 1, 1, 1).mapInPandas(run, "__n long, __b long, __step long"), "mix-steps")
    named = spark.createDataFrame(list(enumerate(names)), "__i long, __s string")
    return plan.join(named, plan["__n"] == named["__i"]).select("__s", "__b", "__step")


def salt(key: str) -> Column:
    """The slice of its source that a row is numbered in."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(SALTS)).cast("int")


def numbered_blocks(df: DataFrame, source: str, key: str, block_rows: int) -> DataFrame:
    """Rows with ``__block``: the block of their source they fall into, at most ``block_rows`` rows each.

    A source is cut into salted slices whose counts are put one after another, so that no task orders a whole
    source. Rows follow a hash of their key; equal rows may change places.
    """
    salted = df.withColumn("__salt", salt(key))
    slices = salted.groupBy(F.col(source).alias("__s"), F.col("__salt").alias("__t")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__s").orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy(source, "__salt").orderBy(F.xxhash64(F.col(key)), F.col(key)))
    ranked = salted.withColumn("__place", place)
    joined = ranked.join(starts, ranked[source].eqNullSafe(starts["__s"]) & (ranked["__salt"] == starts["__t"]))
    return joined.withColumn("__block", F.floor((F.col("__start") + F.col("__place") - 1) / block_rows)).drop(
        "__salt", "__s", "__t", "__start", "__place")


def with_steps(df: DataFrame, weights: Mapping[str | None, float] | None = None, source: str = "source", key: str = "doc_id",
               block_rows: int = BLOCK_ROWS, period: int | None = None, temperature: float = 0.7) -> DataFrame:
    """``df`` with ``__block`` and ``__step``, the step at which the row's block is due; see ``schedule``."""
    spark = df.sparkSession
    blocks = numbered_blocks(df, source, key, block_rows)
    counts = blocks.groupBy(F.col(source).alias("s")).agg(F.max("__block").alias("last"), F.count("*").alias("n")).collect()
    names = [r["s"] for r in sorted(counts, key=lambda r: (r["s"] is None, r["s"]))]
    number = {name: i for i, name in enumerate(names)}
    if weights:
        least = min(weights.values())
        target = {number[s]: weights.get(s, least) for s in names}
    else:
        target = {number[r["s"]]: r["n"] ** temperature for r in counts}
    steps = laid_out(spark, names, {number[r["s"]]: r["last"] + 1 for r in counts}, target, period)
    on = F.col(source).cast("string").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b"))
    return blocks.join(steps, on).select(*df.columns, F.col("__block").cast("long").alias("__block"), "__step")


def schedule(df: DataFrame, weights: Mapping[str | None, float] | None = None, source: str = "source", key: str = "doc_id",
             block_rows: int = BLOCK_ROWS, period: int | None = None, temperature: float = 0.7) -> DataFrame:
    """One row per row of ``df``: key, source, block and the step at which the block is due.

    Every row is kept. Without ``weights`` a source's target is its row count to the power ``temperature``; a source
    the weights do not name, null included, gets the smallest weight given. Ordering by (step, key) gives the mix. Up to the step at which a source
    runs out, and from there to the next, every source is less than one block from its exact share. Null keys and repeated rows are rows like any
    other; an empty table gives none; other columns are not read. A count per source passes the driver, whatever their number.
    """
    slim = df.select(F.col(key).alias("doc_id"), F.col(source).alias("source"))
    placed = with_steps(slim, weights, "source", "doc_id", block_rows, period, temperature)
    return placed.select("doc_id", "source", F.col("__block").alias("block"), F.col("__step").alias("step"))


def steps_by_hash(df: DataFrame, steps: DataFrame, rows: int, source: str, key: str) -> DataFrame:
    """``df`` with ``__step`` and no shuffle, if no two rows of a source have the same hash of their key.

    In a slice of a source steps grow with that hash. A cell is a range of hashes of a slice; it has the steps of its rows and the hash at which
    each begins: some 16 bytes for a block of rows, which are broadcast.
    """
    bits = max(1, (rows // (SALTS * CELL_ROWS)).bit_length())

    def placed(frame: DataFrame, name: str) -> DataFrame:
        hashed = frame.withColumn("__hash", F.xxhash64(F.col(name)))
        return hashed.withColumn("__cell", F.shiftleft(salt(name).cast("long"), bits) + F.shiftright("__hash", 64 - bits))

    begins = placed(steps, "__key").groupBy(F.col("__source").alias("__s"), F.col("__cell").alias("__c"), "__step").agg(F.min("__hash").alias("__from"))
    ranges = begins.groupBy("__s", "__c").agg(F.array_sort(F.collect_list(F.struct("__from", "__step"))).alias("__ranges")).select(
        "__s", "__c", F.col("__ranges.__from").alias("__from"), F.col("__ranges.__step").alias("__steps"))
    found = placed(df, key).join(F.broadcast(ranges), F.col(source).eqNullSafe(F.col("__s")) & (F.col("__cell") == F.col("__c")))
    step = F.expr("__steps[size(filter(__from, x -> x <= __hash)) - 1]")
    return found.select(*df.columns, step.alias("__step"))


def mixed(df: DataFrame, weights: Mapping[str | None, float] | None = None, source: str = "source", key: str = "doc_id") -> DataFrame:
    """All rows and columns of ``df`` in the order of the schedule, over range partitions.

    Null sources are a source, null keys and repeated rows rows like any other; an empty table stays empty. Columns may have any names.
    Steps are found on sources and keys alone and broadcast by the block, so that whole rows are moved once, into order; beyond ``MOST_BROADCAST``
    rows twice, to their step and into order. Only where several rows of a source share a key, or its hash, whole rows are numbered.
    """
    plain, name = numbered_columns(df)
    slim = plain.select(F.col(name[source]).alias("__source"), F.col(name[key]).alias("__key"))
    steps = stage(with_steps(slim, weights, "__source", "__key").drop("__block"), "mix-places")
    if steps.groupBy("__source", F.xxhash64("__key")).count().where("count > 1").head(1):
        placed = with_steps(plain, weights, name[source], name[key])
    elif (rows := steps.count()) <= MOST_BROADCAST:
        placed = steps_by_hash(plain, steps, rows, name[source], name[key])
    else:
        placed = plain.join(steps, plain[name[source]].eqNullSafe(steps["__source"]) & plain[name[key]].eqNullSafe(steps["__key"]))
    return placed.orderBy("__step", name[key]).select(*plain.columns).toDF(*df.columns)
