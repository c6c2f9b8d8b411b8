"""Joins.

No side is broadcast by hand: Spark does so by itself below its size threshold, from
statistics or the measured size of a finished stage, and sorts and merges otherwise.
A hot key is split by the adaptive skew join (see ``session.RUNTIME_OPTIONS``), which
can split the left side of left, semi and anti joins but no side of a full outer join;
``full_outer_coalesce`` therefore salts its hot keys itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.operators.aggregates import distinct_lists


def filter_by_link(df: DataFrame, link: DataFrame, key: str, semi: bool = False) -> DataFrame:
    """Rows that have a link row; one copy per link row, or one only with ``semi``."""
    if semi:
        return df.join(link.select(key), key, "left_semi")
    return df.join(link.select(key), key, "inner")


def lists_through_dictionary(links: DataFrame, terms: DataFrame, key: str, link_id: str, term_id: str,
                             columns: Mapping[str, str]) -> DataFrame:
    """Per key the distinct dictionary values its links lead to.

    Repeated links are removed before the join, so a hot key meets the dictionary once
    per distinct link.
    """
    pairs = links.select(key, link_id).distinct()
    wanted = terms.select(term_id, *dict.fromkeys(columns.values()))
    joined = pairs.join(wanted, pairs[link_id] == wanted[term_id])
    return distinct_lists(joined, [key], columns)


def star_left(base: DataFrame, sides: Sequence[DataFrame], key: str) -> DataFrame:
    """Base with every side table added by left outer joins on one key.

    Sides already aggregated by the key arrive partitioned by it and need no shuffle.
    """
    return reduce(lambda df, side: df.join(side, key, "left"), sides, base)


def full_outer_coalesce(left: DataFrame, right: DataFrame, key: str, prefer_right: Sequence[str] = (),
                        null_keys_match: bool = False) -> DataFrame:
    """Full outer join; columns on both sides become one.

    The left value wins unless the column is named in ``prefer_right``. Null keys match
    nothing, or each other with ``null_keys_match``; as that would pair all with all,
    one side may then have at most one row with a null key.

    Each side is read once and moved once, by key and a salt. The salt spreads null keys, which match
    nothing, and the rows of hot keys, whose partners are copied to every salt. Hot keys are looked for
    only where a side's estimated size exceeds what Spark calls a skewed partition; that job reads the key
    column alone. Rows that agree in all columns share a salt.
    """
    if null_keys_match and all(len(side.where(F.col(key).isNull()).select(key).take(2)) > 1 for side in (left, right)):
        raise ValueError("null keys on both sides repeat; reduce one side to one row per key")
    shared = [c for c in left.columns if c in right.columns and c != key]
    right_key = "__right_key"
    hot_left = hot_keys(left, key)
    hot_right = {k: n for k, n in hot_keys(right, key).items() if k not in hot_left}
    mine = _salted(left, key, hot_left, hot_right, not null_keys_match, -1)
    theirs = _salted(right, key, hot_right, hot_left, not null_keys_match, 1).withColumnsRenamed(
        {key: right_key, "__salt": "__right_salt", "__here": "__there", **{c: f"__right_{c}" for c in shared}})
    same = mine[key].eqNullSafe(theirs[right_key]) if null_keys_match else mine[key] == theirs[right_key]
    both = mine.join(theirs, same & (mine["__salt"] == theirs["__right_salt"]), "full")
    # A hot key has partners on its own side, so a copy that met none of them is no row of the result.
    if hot_left:
        both = both.where(F.col("__here").isNotNull() | F.col(right_key).isNull() | ~F.col(right_key).isin(list(hot_left)))
    if hot_right:
        both = both.where(F.col("__there").isNotNull() | F.col(key).isNull() | ~F.col(key).isin(list(hot_right)))

    def merged(c: str) -> Column:
        mine, theirs = F.col(c), F.col(f"__right_{c}")
        pair = (theirs, mine) if c in prefer_right else (mine, theirs)
        return F.coalesce(*pair).alias(c)

    return both.select(
        F.coalesce(F.col(key), F.col(right_key)).alias(key),
        *[merged(c) if c in shared else F.col(c) for c in left.columns if c != key],
        *[F.col(c) for c in right.columns if c != key and c not in shared],
    )


# A key is hot that has more rows than so many even shuffle partitions.
HOT_PARTS = 2
NULL_SALTS = 1 << 20


# What a plan may make of the files it reads, at most, before its size counts as unknown.
FAN_OUT = 4


def estimated_bytes(df: DataFrame, key: str) -> int:
    """A frame's size by Spark's estimates; no job runs.

    Spark multiplies the sizes of joined sides, so the size of the files read bounds the estimate. Only the key's plan is
    optimised for it; its size is scaled up to all columns.
    """
    narrow = df.select(F.col(key))
    plan = narrow._jdf.queryExecution().optimizedPlan()
    return min(int(str(plan.stats().sizeInBytes())) * len(df.columns), FAN_OUT * read_bytes(narrow))


def read_bytes(df: DataFrame) -> int:
    """Bytes of what a frame reads by Spark's estimates, its files' sizes for files; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def hot_keys(df: DataFrame, key: str) -> dict:
    """Keys with more rows than ``HOT_PARTS`` even shuffle partitions, and the salts each one needs.

    There are fewer of them than shuffle partitions. A side too small for a skewed partition has none.
    """
    conf = df.sparkSession.conf
    if estimated_bytes(df, key) <= _bytes(conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")):
        return {}
    parts = int(conf.get("spark.sql.shuffle.partitions"))
    watch = Observation(f"rows by {key}")
    counts = df.select(F.col(key).alias("k")).observe(watch, F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.count("*").alias("n"))
    # As many as can be hot at all; one null key may be among them.
    most = counts.orderBy(F.desc("n")).limit(parts // HOT_PARTS + 1).collect()
    rows = watch.get["n"]
    return {r["k"]: -(-r["n"] * parts // rows) for r in most if r["k"] is not None and r["n"] * parts > HOT_PARTS * rows}


def _bytes(setting: str) -> int:
    """A byte size as Spark writes it: a number, or one with a unit."""
    digits = setting.strip().lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(digits[:-1]) << units[digits[-1]] if digits[-1] in units else int(digits)


def _salted(df: DataFrame, key: str, hot: Mapping, copied: Mapping, spread_nulls: bool, sign: int) -> DataFrame:
    """Rows with ``__salt``: 0, one of many for a null or hot key, and a copy for each salt of a key that is hot on the other side."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    content = F.xxhash64(*[F.col(f"`{c}`") for c, kind in kinds.items() if hashable(kind)])
    salt = F.lit(0)
    if spread_nulls:
        salt = F.when(F.col(key).isNull(), (F.pmod(content, F.lit(NULL_SALTS)) + 1) * sign).otherwise(salt)
    for k, n in hot.items():
        salt = F.when(F.col(key) == k, F.pmod(content, F.lit(n))).otherwise(salt)
    marked = df.withColumns({"__salt": salt.cast("long"), "__here": F.lit(True)})
    if not copied:
        return marked
    copies = F.array(F.col("__salt"))
    for k, n in copied.items():
        copies = F.when(F.col(key) == k, F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).otherwise(copies)
    return marked.withColumn("__salt", F.explode(copies))


def hashable(kind: T.DataType) -> bool:
    """Whether Spark can hash values of a type: all but maps and variants."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def join_on_pairs(left: DataFrame, right: DataFrame, pairs: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join on differently named keys; both key columns stay."""
    condition = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in pairs.items()])
    return left.join(right, condition, how)


def map_lookup(df: DataFrame, name: str, mapping: Mapping | DataFrame, out: str) -> DataFrame:
    """Translate a column; unknown values give null.

    A mapping, of any size, or a frame with the columns ``key`` and ``value`` and one row per key is joined; keys are
    read as the column's type, those it cannot hold match nothing. A replaced column keeps its place.
    """
    if not isinstance(mapping, DataFrame):
        rows = [(str(k), v) for k, v in mapping.items() if k is not None]
        kind = {bool: "boolean", int: "long", float: "double"}.get(type(rows[0][1]) if rows else str, "string")
        mapping = df.sparkSession.createDataFrame(rows, f"key string, value {kind}")
    side = mapping.select(F.col("key").try_cast(df.schema[name].dataType).alias("__key"), F.col("value").alias("__value"))
    joined = df.join(side.where(F.col("__key").isNotNull()), df[name] == F.col("__key"), "left")
    columns = [F.col("__value").alias(out) if c == out else joined[c] for c in df.columns]
    return joined.select(*columns, *([] if out in df.columns else [F.col("__value").alias(out)]))


# So many ids are compared one by one in the scan, which then reads the row groups that may hold them; more of them prune by
# their least and greatest only.
POINT_IDS = 200


def rows_by_ids(ids: DataFrame | Sequence, df: DataFrame, id_name: str, position: str) -> DataFrame:
    """Rows for a list of ids, in list order, repeats kept.

    ``ids`` is a list, or a frame with the id and its place in the list; unknown and null ids give no row. A list is also a
    filter that the scan takes over: in a table landed with ``cluster_by`` its statistics and bloom filters leave most
    row groups unread.
    """
    if not isinstance(ids, DataFrame):
        known = [(i, n) for n, i in enumerate(ids) if i is not None]
        kind = df.schema[id_name].dataType.simpleString()
        distinct = list(dict.fromkeys(i for i, _ in known))
        one_of = reduce(lambda a, b: a | b, [df[id_name] == i for i in distinct]) if 0 < len(distinct) <= POINT_IDS else df[id_name].isin(distinct)
        df = df.where(one_of)
        ids = df.sparkSession.createDataFrame(known, f"`{id_name}` {kind}, `{position}` int")
    wanted = ids.select(F.col(id_name).alias("__id"), F.col(position))
    return (
        wanted.join(df, F.col("__id") == df[id_name])
        .select(position, *[df[c] for c in df.columns if c != position])
        .orderBy(position)
    )
