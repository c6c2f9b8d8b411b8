"""Counting, listing and deduplicating.

Every aggregate combines on the map side. Where a group's values become a list, the
(key, value) pairs are made distinct first, so a hot key is spread over tasks by its
values and only the distinct ones, which are the result, meet in one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.functions import lists
from trialweave.functions import text as txt
from trialweave.functions.values import holds
from trialweave.operators.columns import learn_names, quoted


def distinct_lists(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Per key the sorted distinct non-null values of some columns, as ``{new: old}``.

    A key without values in a column gets an empty list there.
    """
    names = list(columns)
    if len(names) == 1:
        item = quoted(columns[names[0]]).cast("string").alias("item")
        return df.select(*keys, item).distinct().groupBy(*keys).agg(
            F.sort_array(F.collect_list("item")).alias(names[0])
        )
    tagged = F.explode(F.array(*[
        F.struct(F.lit(i).alias("tag"), quoted(columns[name]).cast("string").alias("item"))
        for i, name in enumerate(names)
    ]))
    pairs = df.select(*keys, tagged.alias("pair")).select(*keys, "pair.tag", "pair.item").distinct()
    return pairs.groupBy(*keys).agg(*[
        F.sort_array(F.collect_list(F.when(F.col("tag") == i, F.col("item")))).alias(name)
        for i, name in enumerate(names)
    ])


def merge_lists(df: DataFrame, key: str, name: str, separator: str = ", ", out: str | None = None) -> DataFrame:
    """Per key the sorted union of the items of a delimited text column."""
    items = (
        df.where(quoted(name).isNotNull() & quoted(key).isNotNull())
        .select(key, F.explode(lists.split_at(quoted(name), separator)).alias("item"))
        .distinct()
    )
    return items.groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_list("item")), separator).alias(out or name)
    )


def value_counts(df: DataFrame, name: str, out: str = "n") -> DataFrame:
    """Frequency of each value, nulls dropped, most frequent first, ties by value."""
    return (
        df.where(quoted(name).isNotNull())
        .groupBy(quoted(name).alias(name))
        .agg(F.count("*").alias(out))
        .orderBy(F.desc(out), quoted(name))
    )


def value_share(df: DataFrame, name: str, value, out: str = "share") -> DataFrame:
    """Share of one value among the non-null ones, 0 where it never occurs."""
    hit = (quoted(name) == value).cast("double")
    return df.agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias(out))


def count_by_year(df: DataFrame, name: str, out: str = "n") -> DataFrame:
    """Rows per year of a date column, undated rows dropped."""
    return (
        df.where(quoted(name).isNotNull())
        .groupBy(F.year(quoted(name)).alias("year"))
        .agg(F.count("*").alias(out))
        .orderBy("year")
    )


def exploded_counts(df: DataFrame, items: Column, out: str = "n") -> DataFrame:
    """Frequency of array items over all rows, null items dropped."""
    return value_counts(df.select(F.explode(items).alias("item")), "item", out)


def flag_totals(df: DataFrame, flags: Mapping[str, str], label: str = "label", out: str = "total") -> DataFrame:
    """Number of true rows per flag as (label, total) rows, from one pass.

    ``flags`` maps labels to column names; columns the frame lacks are left out.
    """
    known = {shown: name for shown, name in flags.items() if name in df.columns}
    totals = df.agg(*[F.count_if(quoted(name).cast("boolean")).alias(f"t{i}")
                      for i, name in enumerate(known.values())])
    pairs = F.array(*[F.struct(F.lit(shown).alias(label), F.col(f"t{i}").alias(out))
                      for i, shown in enumerate(known)])
    return totals.select(F.inline(pairs))


def labelled_counts(df: DataFrame, condition: Column, yes: str, no: str, out: str = "n") -> DataFrame:
    """Rows that meet a condition and rows that do not."""
    return df.groupBy(F.when(holds(condition), yes).otherwise(no).alias("label")).agg(F.count("*").alias(out))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in an explicit order.

    Spark keeps one candidate per key in each map task before it shuffles.
    """
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def dedup_all(df: DataFrame) -> DataFrame:
    """Each distinct row once."""
    return df.distinct()


def distinct_options(df: DataFrame, name: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(quoted(name).alias(name)).where(quoted(name).isNotNull()).distinct().orderBy(quoted(name))


def list_options(df: DataFrame, name: str, out: str = "option") -> DataFrame:
    """Sorted distinct items of a list column, normalised."""
    items = df.select(F.explode(quoted(name)).alias("item")).where("item IS NOT NULL")
    return items.select(txt.normalise(F.col("item")).alias(out)).distinct().orderBy(out)


def pivot_counts(df: DataFrame, keys: Sequence[str], name: str, values: Sequence[str] | None = None,
                 limit: int = 5000) -> DataFrame:
    """Rows per key and category, one column per category, 0 where none."""
    if values is None:
        values = learn_names(df, F.array(quoted(name).cast("string")), limit)
    return df.groupBy(*keys).agg(*[F.count_if(quoted(name) == v).alias(v) for v in values])


def top_per_section(df: DataFrame, section: str, total: str, label: str, limits: Mapping[str, int]) -> DataFrame:
    """Keep the first n labels of the sections named in ``limits``, all of the others.

    Labels of an unlimited section rank in groups of their own, so one rank filter
    serves all sections and Spark cuts long sections in each task before the shuffle.
    """
    alone = F.when(~F.col(section).isin(*limits), F.col(label))
    window = Window.partitionBy(section, alone).orderBy(F.desc(total), F.col(label))
    allowed = F.lit(1)
    for name, limit in limits.items():
        allowed = F.when(F.col(section) == name, limit).otherwise(allowed)
    return (
        df.withColumn("__rank", F.row_number().over(window))
        .where(F.col("__rank") <= max(limits.values()))
        .where(F.col("__rank") <= allowed)
        .drop("__rank")
    )
