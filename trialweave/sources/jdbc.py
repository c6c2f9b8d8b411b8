"""Remote relational tables, read-only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str, password: str, partition_column: str | None = None,
                 bounds: tuple[int, int] | None = None, partitions: int | None = None,
                 timeout_seconds: int = 10, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; credentials are always the caller's.

    With a partition column the table is read in ``partitions`` parallel ranges; Spark
    then needs the bounds as well.
    """
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
        "loginTimeout": str(timeout_seconds),
        "pushDownPredicate": "true",
    }
    if partition_column is None:
        return options
    if bounds is None or partitions is None:
        raise ValueError("a partition column needs bounds and a number of partitions")
    return options | {
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def prefix_predicates(column: str, prefixes: Sequence[str]) -> list[str]:
    """Conditions that cut a table by the beginnings of a text key, one task each.

    The ranges go from one prefix to the next; the first takes all below and null, the last all above.
    """
    cuts = ["'" + p.replace("'", "''") + "'" for p in sorted(set(prefixes))]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_table(spark: SparkSession, options: dict[str, str], predicates: Sequence[str] | None = None) -> DataFrame:
    """The table in one task, in ranges of a numeric column, or in one task per predicate."""
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    known = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=known)
