"""Documents whose keys nobody has declared: JSON as VARIANT, its fields learned in one aggregation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.operators.columns import quoted

Path = tuple[str, ...]


def parsed(text: Column) -> Column:
    """JSON text as a variant; unreadable text gives null."""
    return F.try_parse_json(text)


def json_path(steps: Sequence[str]) -> str | None:
    """A variant path for any keys, dots and blanks included; none where a key holds both kinds of quotes."""
    out = "$"
    for step in steps:
        quote = '"' if "'" in step else "'"
        if quote in step or "\\" in step:
            return None
        out += f"[{quote}{step}{quote}]"
    return out


def field(document: Column, steps: Sequence[str], kind: str = "string") -> Column:
    """One field of a variant; a missing branch or another type gives null. Objects and arrays come as JSON text."""
    path = json_path(steps)
    return F.lit(None).cast(kind) if path is None else F.try_variant_get(document, path, kind)


def learned_schema(df: DataFrame, name: str) -> T.StructType:
    """The fields that the documents of a variant column have between them; one aggregation with partial results.

    Documents that are no objects have no fields; only if there are any, a second aggregation leaves them out.
    """
    def learned(rows: DataFrame) -> T.DataType:
        found = rows.agg(F.schema_of_variant_agg(quoted(name)).alias("s")).first()["s"]
        return T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")) if found else T.NullType()

    kind = learned(df)
    if isinstance(kind, T.VariantType):
        kind = learned(df.where(F.try_variant_get(quoted(name), "$", "map<string,variant>").isNotNull()))
    return kind if isinstance(kind, T.StructType) else T.StructType([])


def leaves(schema: T.StructType, above: Path = ()) -> Iterator[tuple[Path, list[Path]]]:
    """Paths of the fields without fields of their own. An array is one such field; with it come the paths inside its items."""
    for f in schema.fields:
        path = (*above, f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from leaves(f.dataType, path)
            continue
        item = f.dataType
        while isinstance(item, T.ArrayType):
            item = item.elementType
        inside = [p for _, ps in leaves(item, path) for p in ps] if isinstance(item, T.StructType) and item is not f.dataType else []
        yield path, inside or [path]


def undeclared_paths(schema: T.StructType, declared: Sequence[Path]) -> list[Path]:
    """Paths of all fields that no declared path names; an array counts as declared if all fields of its items do."""
    known = set(declared)
    return sorted(path for path, inside in leaves(schema) if not known.issuperset(inside) and path not in known)


def with_fields(df: DataFrame, name: str, paths: Sequence[Path], prefix: str) -> DataFrame:
    """One text column per path, named ``prefix.step.step``."""
    return df.select("*", *[field(quoted(name), p).alias(".".join([prefix, *p])) for p in paths])


def with_undeclared(df: DataFrame, name: str, declared: Sequence[Path], prefix: str, limit: int = 500) -> DataFrame:
    """A variant column's undeclared fields as text columns; more of them than ``limit`` are an error, never a silent cut.

    Runs one job, which learns the names; pass known ones to ``with_fields`` to save it. Keys that hold both kinds of quotes or a
    backslash cannot be named by a path; their columns are null, and the variant still has them.
    """
    paths = undeclared_paths(learned_schema(df, name), declared)
    if len(paths) > limit:
        raise ValueError(f"more than {limit} undeclared fields; pass the wanted ones to with_fields")
    return with_fields(df, name, paths, prefix)
