"""Choosing, renaming, dropping and deriving columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.functions import lists, text


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[quoted(name) for name in wanted if name in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def drop_by_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.select(*[quoted(name) for name in df.columns if not name.startswith(prefixes)])


def assign(df: DataFrame, *steps: Mapping[str, Column]) -> DataFrame:
    """Add derived columns; a later step sees the columns of the earlier ones."""
    for step in steps:
        df = df.withColumns(dict(step))
    return df


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows without any value; a column that cannot be null leaves nothing to drop."""
    return df.dropna(how="all") if all(f.nullable for f in df.schema.fields) else df


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value; one pass decides for all columns."""
    counts = df.agg(*[F.count(quoted(name)).alias(f"c{i}") for i, name in enumerate(df.columns)]).first()
    return df.select(*[quoted(name) for i, name in enumerate(df.columns) if counts[i]])


def dropna_subset(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.dropna(subset=list(names))


def align_schema(df: DataFrame, schema: T.StructType, constants: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null, others gone, types cast."""
    fixed = dict(constants or {})

    def column(field: T.StructField) -> Column:
        if field.name in fixed:
            return F.lit(fixed[field.name]).cast(field.dataType).alias(field.name)
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if nullable(df.schema[field.name].dataType) == nullable(field.dataType):
            return quoted(field.name)
        return quoted(field.name).try_cast(nullable(field.dataType)).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed inside: no cast takes a possible null away."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in kind.fields])
    return kind


def learn_names(df: DataFrame, items: Column, limit: int = 5000) -> list[str]:
    """Distinct items of an array column, sorted, to be used as column names.

    Column names live in the plan, so their number is bounded: more than ``limit``
    is an error, never a silent cut.
    """
    names = df.select(F.explode(items).alias("item")).where("item IS NOT NULL").distinct()
    found = [row["item"] for row in names.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} distinct names; pass the wanted ones")
    return sorted(found)


def json_to_columns(df: DataFrame, name: str, keys: Sequence[str] | None = None, limit: int = 5000) -> DataFrame:
    """Flat JSON object to one text column per key, named ``name.Key_with_underscores``.

    Pass ``keys`` when they are known; otherwise one job learns them, up to ``limit``.
    For open key sets ``lists.json_map`` gives one map column instead.
    """
    mapped = lists.json_map(quoted(name))
    if keys is None:
        keys = learn_names(df, F.map_keys(mapped), limit)
    taken = df.withColumn("__map", mapped)
    return taken.select(
        *[quoted(c) for c in df.columns if c != name],
        *[F.try_element_at("__map", F.lit(key)).alias(f"{name}.{key}") for key in keys],
    )


def list_indicators(df: DataFrame, name: str, separator: str = ", ",
                    values: Sequence[str] | None = None, limit: int = 5000) -> DataFrame:
    """Delimited text to one 0/1 column per item, named ``name.Item_with_underscores``.

    Items that give one name, such as "A b" and "A_b", share a column, 1 if either is there.
    """
    if values is None:
        items = F.filter(lists.split_at(quoted(name), separator), lambda i: i != "")
        values = learn_names(df, items, limit)
    named: dict[str, list[Column]] = {}
    for v in values:
        named.setdefault(f"{name}.{v.strip().replace(' ', '_')}", []).append(lists.has_item(quoted(name), v, separator))
    return df.select(
        *[quoted(c) for c in df.columns if c != name],
        *[(F.greatest(*found) if len(found) > 1 else found[0]).alias(n) for n, found in named.items()],
    )


def category_indicators(df: DataFrame, name: str, values: Sequence[str] | None = None,
                        prefix: str | None = None, limit: int = 5000) -> DataFrame:
    """Category to one boolean column per value, false where the category is missing."""
    if values is None:
        values = learn_names(df, F.array(quoted(name).cast("string")), limit)
    start = f"{prefix}_" if prefix else ""
    return df.withColumns(
        {f"{start}{v}": F.coalesce(quoted(name) == v, F.lit(False)) for v in values}
    )


def word_flags(df: DataFrame, name: str, phrases: Sequence[str]) -> DataFrame:
    """One 0/1 column per phrase, matched on word borders; null text gives 0."""
    return df.withColumns({
        phrase.replace(" ", "_"): F.when(text.has_word(quoted(name), phrase), 1).otherwise(0)
        for phrase in phrases
    })


def quoted(name: str) -> Column:
    """Column by exact name, dots and brackets included."""
    return F.col("`" + name.replace("`", "``") + "`")
