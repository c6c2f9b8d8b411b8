"""Table profiles and exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.operators.columns import quoted


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column as (column, nulls), from one pass."""
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ])))


def column_info(df: DataFrame) -> DataFrame:
    """Type and number of known values per column, from one pass."""
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(kind).alias("type"),
                 F.col(f"n{i}").alias("known"))
        for i, (c, kind) in enumerate(df.dtypes)
    ])))


def describe_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum per numeric column. Runs when called; one row per column comes back."""
    ends = _ends(df, names)
    points = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = _quantiles(df, names, points, ends)
    rows = [(c, at["n"], at["mean"], at["std"], at["min"], *[found[i].get(p) for p in points], at["max"])
            for i, (c, at) in enumerate(zip(names, ends))]
    shown = [f"{c} double" for c in ("mean", "std", "min", *points, "max")]
    return df.sparkSession.createDataFrame(rows, ", ".join(["column string", "count long", *shown]))


# Ranges a searched interval is cut into; so many counts per wanted rank and column reach the driver at most.
RANGES = 2048


@dataclass
class _Interval:
    """A column's values from ``low`` to ``high`` hold the wanted ranks; ``before`` values of the column are smaller."""

    column: int
    low: float
    high: float
    before: int
    ranks: set[int]


def exact_quantiles(df: DataFrame, names: Sequence[str], points: dict[str, float]) -> DataFrame:
    """Interpolated exact quantiles per column, one output column per point; null for a column without values.

    Spark's exact ``percentile`` keeps all distinct values of a column in one task, and a sort would move the table. Here
    the wanted ranks are closed in on: each pass counts the values of a few ranges, and only the range that holds a rank is cut
    again, until it holds one value. Two or three scans do for most columns; nothing is sorted, staged or shuffled but the
    counts. Not-a-number counts as the greatest value.
    """
    found = _quantiles(df, names, points, _ends(df, names))
    schema = ", ".join(["column string", *[f"`{p}` double" for p in points]])
    return df.sparkSession.createDataFrame([(n, *[found[i].get(p) for p in points]) for i, n in enumerate(names)], schema)


def _ends(df: DataFrame, names: Sequence[str]) -> list:
    """Per column the counts, mean, deviation and ends of its values, from one pass."""
    def one(i: int, v: Column) -> Column:
        f = _finite(v)
        return F.struct(
            F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.count_if(v == -math.inf).alias("least"), F.count(f).alias("finite"), F.count_if(v == math.inf).alias("most"),
            F.min(f).alias("low"), F.max(f).alias("high")).alias(f"c{i}")

    return list(df.agg(*[one(i, quoted(n).cast("double")) for i, n in enumerate(names)]).first())


def _finite(v: Column) -> Column:
    return F.when(F.abs(v) < math.inf, v)


def _quantiles(df: DataFrame, names: Sequence[str], points: dict[str, float], ends: list) -> list[dict[str, float]]:
    """Per column the wanted quantiles by point; none for a column without values."""
    finite = [_finite(quoted(n).cast("double")) for n in names]
    found: dict[tuple[int, int], float] = {}
    wanted, searched = [], []
    for i in range(len(names)):
        at = ends[i]
        ranks = set()
        for point, share in points.items():
            if at["n"]:
                place = share * (at["n"] - 1)
                low, weight = math.floor(place), place - math.floor(place)
                wanted.append((i, point, low, weight))
                ranks |= {low, low + 1} if weight else {low}
        inner = {r for r in ranks if at["least"] <= r < at["least"] + at["finite"]}
        for r in ranks - inner:
            found[i, r] = -math.inf if r < at["least"] else math.inf if r < at["least"] + at["finite"] + at["most"] else math.nan
        if inner:
            searched.append(_Interval(i, at["low"], at["high"], at["least"], inner))
    while searched:
        searched = _narrowed(df, finite, searched, found)
    out: list[dict[str, float]] = [{} for _ in names]
    for i, point, rank, weight in wanted:
        value = found[i, rank]
        out[i][point] = value if not weight else value * (1 - weight) + found[i, rank + 1] * weight
    return out


def _narrowed(df: DataFrame, values: Sequence[Column], searched: Sequence[_Interval], found: dict[tuple[int, int], float]) -> list[_Interval]:
    """One pass over the searched intervals: what is left to search. Found values go into ``found``."""
    todo = []
    for at in searched:
        if at.low == at.high:
            found.update({(at.column, r): at.low for r in at.ranks})
        else:
            todo.append(at)
    if not todo:
        return []

    def entry(number: int, at: _Interval) -> Column:
        v = values[at.column]
        # Halves, so that the width of an interval never exceeds the largest double.
        width = at.high / 2 - at.low / 2
        share = (v / 2 - at.low / 2) / width * RANGES if width else F.when(v == at.low, 0.0).otherwise(float(RANGES - 1))
        inside = v.between(at.low, at.high)
        return F.when(inside, F.struct(F.lit(number).alias("interval"), F.least(F.floor(share), F.lit(RANGES - 1)).alias("range"), v.alias("v")))

    entries = F.explode(F.array(*[entry(i, at) for i, at in enumerate(todo)]))
    counted = df.select(entries.alias("e")).where("e IS NOT NULL").groupBy("e.interval", "e.range").agg(
        F.count("*").alias("n"), F.min("e.v").alias("low"), F.max("e.v").alias("high")).collect()
    left = []
    for number, at in enumerate(todo):
        before = at.before
        for r in sorted((r for r in counted if r["interval"] == number), key=lambda r: r["range"]):
            ranks = {rank for rank in at.ranks if before <= rank < before + r["n"]}
            if ranks:
                left.append(_Interval(at.column, r["low"], r["high"], before, ranks))
            before += r["n"]
    return left
