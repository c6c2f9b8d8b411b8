"""Parquet and CSV in and out, landings with run records, and the inventory of sources."""

from __future__ import annotations

import time
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.functions import lists
from trialweave.operators.columns import quoted
from trialweave.sources import landing

# How null is written in CSV, so that empty text stays empty text.
NULL_MARK = "\\N"
RUN_SCHEMA = "source string, started timestamp, seconds double, items long, errors long, reason string"


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, line_breaks: bool = False,
             null_mark: str = NULL_MARK) -> DataFrame:
    """CSV with a header; the schema is given, so no pass is spent on guessing it.

    Quoted cells may hold doubled quotes, and line breaks with ``line_breaks``: then a file cannot be
    cut and is read by one task. Blanks around a text are its own; empty text is not null.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, multiLine=line_breaks, escape='"', nullValue=null_mark, emptyValue="",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, separator: str = ", ", null_item: str = "null", null_mark: str = NULL_MARK) -> None:
    """CSV with a header; arrays become joined text, their null items ``null_item``, nulls ``null_mark``."""
    flatten_arrays(df, separator, null_item).write.mode("overwrite").options(
        header=True, escape='"', nullValue=null_mark, emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def flatten_arrays(df: DataFrame, separator: str = ", ", null_item: str = "null") -> DataFrame:
    """Array columns as joined text, null items shown as ``null_item``; the others unchanged."""
    return df.select(*[
        lists.to_text(quoted(f.name).cast("array<string>"), separator, null_item).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else quoted(f.name)
        for f in df.schema.fields
    ])


def write_tagged(df: DataFrame, path: str) -> None:
    """Parquet with array columns as tagged text, for readers without list types."""
    df.select(*[
        lists.tag_encode(quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else quoted(f.name)
        for f in df.schema.fields
    ]).write.mode("overwrite").parquet(path)


def read_tagged(spark: SparkSession, path: str, list_columns: list[str]) -> DataFrame:
    """Parquet written by :func:`write_tagged`, the named columns as arrays again."""
    df = spark.read.parquet(path)
    return df.withColumns({c: lists.tag_decode(quoted(c)) for c in list_columns})


def land_with_report(df: DataFrame, root: str, source: str, is_bad: Column) -> DataFrame:
    """Land a source and return its run record; counted while the rows are written.

    A landing that fails leaves a record too: its reason is the error's name, its counts are null. The last good version
    of the source stays readable.
    """
    watch = Observation(f"landing {source}")
    observed = df.observe(watch, F.count(F.lit(1)).alias("items"), F.count_if(is_bad).alias("errors"))
    started, clock, reason = datetime.now(timezone.utc), time.monotonic(), "finished"
    seen: dict = {"items": None, "errors": None}
    try:
        landing.land(observed, root, source)
        seen = watch.get
    except Exception as error:  # whatever stops a landing is what the record is for
        reason = f"failed: {type(error).__name__}"
    row = (source, started, time.monotonic() - clock, seen["items"], seen["errors"], reason)
    return df.sparkSession.createDataFrame([row], RUN_SCHEMA)


def append_run(run: DataFrame, path: str) -> None:
    """Add a run record to the table of runs."""
    run.write.mode("append").parquet(path)


def inventory(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Records and last update per source."""
    def one(source: str, path: str) -> DataFrame:
        return spark.read.parquet(path).select("_metadata.file_modification_time").agg(
            F.lit(source).alias("source"),
            F.max("file_modification_time").alias("last_update"),
            F.count("*").alias("total_records"),
        )

    return reduce(DataFrame.unionByName, [one(s, p) for s, p in paths.items()])


def infer_types(df: DataFrame) -> DataFrame:
    """Give landed text columns the narrowest type that reads all their values.

    Tried in order: whole number, long whole number, number, boolean, date, timestamp. One
    pass counts the values each type can read; a column without values stays text, as do
    codes with leading zeros and whole numbers that no type holds exactly.
    """
    # Candidate types and the shape a value must have for each.
    candidates = {
        "bigint": r"^[+-]?(0|[1-9]\d*)$",
        "decimal(38,0)": r"^[+-]?(0|[1-9]\d*)$",
        "double": r"^[+-]?((0|[1-9]\d*)\.\d*|\.\d+|(0|[1-9]\d{0,14})|(0|[1-9]\d*)(\.\d*)?[eE][+-]?\d+|\.\d+[eE][+-]?\d+)$",
        "boolean": r"^(true|false|True|False)$",
        "date": r"^\d{4}-\d{2}-\d{2}$",
        "timestamp_ntz": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$",
    }
    texts = [name for name, kind in df.dtypes if kind == "string"]
    if not texts:
        return df

    def fits(name: str, kind: str) -> Column:
        return quoted(name).rlike(candidates[kind]) & quoted(name).try_cast(kind).isNotNull()

    counts = df.agg(*[
        F.struct(F.count(quoted(name)).alias("known"),
                 *[F.count_if(fits(name, kind)).alias(kind) for kind in candidates]).alias(f"c{i}")
        for i, name in enumerate(texts)
    ]).first()
    chosen = {}
    for i, name in enumerate(texts):
        known = counts[i]["known"]
        chosen[name] = next((k for k in candidates if known and counts[i][k] == known), "string")
    return df.withColumns({n: quoted(n).try_cast(k) for n, k in chosen.items() if k != "string"})
