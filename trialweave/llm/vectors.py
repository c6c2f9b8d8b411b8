"""What the operators on vectors share: which rows take part, and numpy forms that travel as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INFINITE = float("inf")
LONG = (-(1 << 63), (1 << 63) - 1)


def finite(vector: Column) -> Column:
    """Whether a vector is known, not empty and has known, finite components only."""
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < INFINITE, F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & sound, F.lit(False))


def one_row_per_id(rows: DataFrame, key: str, *rest: str) -> DataFrame:
    """Rows that share an id count once, with the greatest of ``rest``."""
    best = F.max(F.struct(*rest)).alias("__best")
    return rows.groupBy(key).agg(best).select(key, *[F.col("__best")[c].alias(c) for c in rest])


def numbers(count: int) -> Column:
    """The longs from 0 to ``count`` - 1 as an array."""
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def narrowed(matrix):
    """The smallest integer type that holds whole-numbered doubles, or the doubles themselves."""
    import numpy as np

    most = np.abs(matrix).max(initial=0)
    for kind in ("int16", "int32"):
        if most <= np.iinfo(kind).max:
            return kind, matrix.astype(kind).tobytes()
    return "float64", matrix.astype("float64").tobytes()


def integer_products(a, b):
    """Exact inner products of whole-numbered rows; beyond the range of a long the nearest long.

    Doubles are exact below 2**53. Beyond it Python's integers take over, which is slow and right.
    """
    import numpy as np

    a, b = a.astype("float64"), b.astype("float64")
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 2.0 ** 53:
        return (a @ b.T).astype("int64")
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a).dot(whole(b).T)
    return np.frompyfunc(lambda x: min(max(x, LONG[0]), LONG[1]), 1, 1)(exact).astype("int64")
