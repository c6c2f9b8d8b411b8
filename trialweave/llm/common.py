"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows handed to a Python worker at once. Texts and pages may be long, so a batch is kept short.
BATCH_ROWS = "256"

# A filter of keys has 32 bits a key, in bitmaps of 32,768 bits, and no more than 32 MB in all: with more keys it lets more rows through.
FILTER_BITS = 32
BITMAP_BITS = 32_768
MOST_BITMAPS = 8192

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def numbered_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by number, so that no helper column meets a name of the user's, and the new name of each."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name ``df`` does not use, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def split_by_keys(rows: DataFrame, on: list[str], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose columns ``on`` may be a row of ``keys``, and those that surely are none.

    The hash of a key is a bit of a broadcast filter, so that whole rows need not be shuffled to learn that a join does not touch them. The first
    part has a few rows too many, hence still has to be joined. ``keys`` has the columns of ``on`` in their order and types; it is read twice.
    """
    maps = min(MOST_BITMAPS, -(-keys.count() * FILTER_BITS // BITMAP_BITS) or 1)

    def place(columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(maps * BITMAP_BITS))

    at = place([F.col(c) for c in keys.columns])
    name, map_, bits = (free_name(rows, c) for c in ("__place", "__map", "__bits"))
    dealt = keys.select(F.floor(at / BITMAP_BITS).alias(map_), (at % BITMAP_BITS).alias("bit")).repartition(map_)
    bitmaps = F.broadcast(dealt.groupBy(map_).agg(F.bitmap_construct_agg("bit").alias(bits)))
    placed = rows.withColumn(name, place([rows[c] for c in on]))
    joined = placed.join(bitmaps, F.floor(F.col(name) / BITMAP_BITS) == F.col(map_), "left")
    byte = F.conv(F.hex(F.expr(f"substring({bits}, cast({name} % {BITMAP_BITS} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col(name) % 8).cast("int")) == 1, F.lit(False))
    return tuple(joined.where(x).drop(name, map_, bits) for x in (hit, ~hit))
