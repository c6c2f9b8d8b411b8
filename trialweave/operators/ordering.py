"""Sorting, top-k, stable samples and row numbers over a whole table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.operators.columns import quoted
from trialweave.session import stage

# monotonically_increasing_id puts the partition above bit 33 and the row below it.
_ROW_BITS = 33


def sort_nulls_last(df: DataFrame, name: str, descending: bool = True, *ties: str) -> DataFrame:
    c = quoted(name)
    first = c.desc_nulls_last() if descending else c.asc_nulls_last()
    return df.orderBy(first, *[quoted(t) for t in ties])


def most_recent(df: DataFrame, name: str, n: int, *ties: str) -> DataFrame:
    """The n rows with the latest date; Spark keeps n candidates per task."""
    return sort_nulls_last(df, name, True, *ties).limit(n)


def sample_order(key: str, seed: int = 123) -> list[Column]:
    """A shuffled order that depends on nothing but the key and the seed."""
    return [F.md5(F.concat(quoted(key).cast("string"), F.lit(f":{seed}"))), quoted(key)]


def seeded_shuffle(df: DataFrame, key: str, seed: int = 123) -> DataFrame:
    return df.orderBy(*sample_order(key, seed))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 123) -> DataFrame:
    """n rows drawn by key and seed; the same rows however the table is partitioned."""
    return seeded_shuffle(df, key, seed).limit(n)


def staged_in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows range-sorted and written, with their partition and place as columns.

    The copy fixes both columns: range borders are drawn from samples and would differ
    if the sort ran again.
    """
    placed = df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id())
    return stage(placed, "ordered").withColumns({
        "__part": F.shiftright("__at", _ROW_BITS),
        "__row": F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1),
    })


def with_ordinals(df: DataFrame, order: Sequence[Column], out: str = "ordinal") -> tuple[DataFrame, int]:
    """Number all rows from 0 in an order; returns the frame and its row count.

    A window without keys would sort the table in one task. Here one range sort places
    the rows and only one count per partition passes the driver.
    """
    placed = staged_in_order(df, order)
    sizes = {r["__part"]: r["n"] for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(sizes)
    starts = [0, *accumulate(sizes[p] for p in parts)]
    numbered = _shift(placed, dict(zip(parts, starts)), out)
    return numbered.select(*[quoted(c) for c in df.columns], out), starts[-1]


def _shift(placed: DataFrame, starts: dict[int, int], out: str) -> DataFrame:
    spark = placed.sparkSession
    # One row per partition of the sort, hence a bounded broadcast: the table itself does not move.
    offsets = F.broadcast(spark.createDataFrame(list(starts.items()), "__p long, __start long"))
    joined = placed.join(offsets, placed["__part"] == F.col("__p"))
    return joined.withColumn(out, F.col("__start") + F.col("__row"))


def chunk_rows(df: DataFrame, order: Sequence[Column], size: int, proportion: float = 1.0,
               chunk: str = "chunk", ordinal: str = "ordinal") -> DataFrame:
    """Cut the ordered table into chunks of ``size``; keep the first share of the chunks."""
    numbered, total = with_ordinals(df, order, ordinal)
    kept = math.ceil(math.ceil(total / size) * proportion)
    numbered = numbered.withColumn(chunk, F.expr(f"`{ordinal}` div {size}"))
    return numbered if kept * size >= total else numbered.where(F.col(ordinal) < kept * size)


def chunk_context(df: DataFrame, line: Column, header: str, chunk: str = "chunk",
                  ordinal: str = "ordinal", out: str = "context") -> DataFrame:
    """One text block per chunk: the header, then the lines in order.

    A chunk holds at most the size it was cut with, so the list in a group is bounded.
    """
    lines = F.sort_array(F.collect_list(F.struct(F.col(ordinal).alias("o"), line.alias("t"))))
    body = F.array_join(F.transform(lines, lambda e: e["t"]), "\n")
    return df.groupBy(chunk).agg(F.concat(F.lit(header + "\n"), body, F.lit("\n")).alias(out))
