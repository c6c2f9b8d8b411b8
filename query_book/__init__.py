"""Registered queries: each operator on the driver tables, beside the SQL that checks it.

Every query reads whole tables. Null and malformed cases the tables lack are derived
from their columns inside the query, by the same rule in Spark and in SQL.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialweave.session import staging_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables by name, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def scratch(self, label: str) -> str:
        return staging_path(self.spark, label)


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""
    def register(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(tune(spark), folder))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def day(c: Column) -> Column:
    """Dates as text: engines hand them out in different types."""
    return F.date_format(c, "yyyy-MM-dd")


def joined(c: Column) -> Column:
    """Lists as text, for the same reason."""
    return F.array_join(c, "|")


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a table spread over all tasks, for tables of few files whose rows grow to much more than the table holds."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def load() -> None:
    for name in ("sources", "values", "rows", "joining", "counting", "order", "reports", "crawled"):
        importlib.import_module(f"query_book.{name}")
