"""A facet index: for every option of every facet a bitmap of the studies that have it.

Studies are numbered once; a bitmap covers 32,768 numbers. A choice of options is answered from the index alone: the bitmaps of
one facet's options are united, those of the facets intersected, and the counts of all options under the choice are the
sizes of their bitmaps' intersections with it. No study is read again until rows are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.functions import text
from trialweave.operators.columns import quoted
from trialweave.operators.ordering import with_ordinals

NUMBER = "study_number"


def options_of(c: Column, is_list: bool = True) -> Column:
    """A column's options: normalised texts without blanks and repeats; a single value counts as a list of one."""
    items = F.coalesce(c.cast("array<string>") if is_list else F.array(c.cast("string")), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(items, text.normalise), lambda x: x != ""))


def numbered(studies: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The studies with ``study_number``, from 1 in an explicit order; written once, as the index refers to it."""
    rows, _ = with_ordinals(studies, order, NUMBER)
    return rows.withColumn(NUMBER, F.col(NUMBER) + 1)


def facet_index(studies: DataFrame, facets: Mapping[str, Column]) -> DataFrame:
    """``facet, option, bucket, bitmap`` of numbered studies; ``facets`` name arrays as from ``options_of``.

    Bitmaps are put together from partial ones of each task, so a common option is no hot group.
    """
    def named(facet: str, options: Column) -> Column:
        return F.transform(options, lambda o: F.struct(F.lit(facet).alias("facet"), o.alias("option")))

    entries = F.explode(F.concat(*[named(facet, options) for facet, options in facets.items()]))
    listed = studies.select(F.col(NUMBER), entries.alias("e")).where("e.option IS NOT NULL")
    place = listed.select("e.facet", "e.option", F.bitmap_bucket_number(NUMBER).alias("bucket"), F.bitmap_bit_position(NUMBER).alias("bit"))
    return place.groupBy("facet", "option", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def chosen_studies(index: DataFrame, choice: Mapping[str, Sequence[str]]) -> DataFrame:
    """``bucket, bitmap`` of the studies that have one of the chosen options in every facet chosen; options as in the index."""
    if not choice:
        return index.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    wanted = reduce(lambda a, b: a | b, [(F.col("facet") == f) & F.col("option").isin(list(options)) for f, options in choice.items()])
    united = index.where(wanted).groupBy("facet", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    met = united.groupBy("bucket").agg(F.count("*").alias("n"), F.bitmap_and_agg("bitmap").alias("bitmap"))
    return met.where(F.col("n") == len(choice)).drop("n")


def facet_counts(index: DataFrame, choice: Mapping[str, Sequence[str]]) -> DataFrame:
    """``facet, option, studies``: for every option how many of the chosen studies have it, 0 included.

    Without a choice these are the options of the whole table. A study without any option is in no bitmap.
    """
    chosen = chosen_studies(index, choice).withColumnRenamed("bitmap", "chosen")
    both = index.join(chosen, "bucket", "left")
    pair = both.select("facet", "option", "bucket", F.col("chosen").isNotNull().alias("met"), F.explode(F.array("bitmap", F.coalesce("chosen", "bitmap"))).alias("bitmap"))
    common = pair.groupBy("facet", "option", "bucket").agg(F.first("met").alias("met"), F.bitmap_count(F.bitmap_and_agg("bitmap")).alias("n"))
    return common.groupBy("facet", "option").agg(F.sum(F.when(F.col("met"), F.col("n")).otherwise(0)).alias("studies"))


def rows_of(studies: DataFrame, chosen: DataFrame) -> DataFrame:
    """The numbered studies whose bit is set in ``chosen``."""
    bit = F.bitmap_bit_position(NUMBER)
    placed = studies.withColumns({"__bucket": F.bitmap_bucket_number(NUMBER), "__bit": bit})
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = placed.join(chosen.withColumnRenamed("bucket", "__chosen"), F.col("__bucket") == F.col("__chosen"))
    marked = held.withColumn("__byte", byte).where(F.expr("(shiftright(__byte, cast(__bit % 8 AS int)) & 1) = 1"))
    return marked.select(*[quoted(c) for c in studies.columns])
