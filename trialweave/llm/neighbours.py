"""Approximate nearest neighbours by inner product with randomly rotated one-bit codes.

Index vectors lie in blocks by a hash of their id. A block subtracts its mean, rotates the rests at random and keeps the
signs of the unit rests as packed bits, with three correction scalars a vector: the length of its rest, the inner product
of the unit rest with its own code, and the inner product of the vector with the mean. From these an inner product with any
query is estimated without bias, and the error lies within a known multiple of its spread (see ``EPSILON``).

A query block scans the codes of an index block and keeps, for every query, the vectors whose upper bound reaches the
k-th best lower bound of that block. The k-th best lower bound over all blocks is then the query's bar; what cannot reach
it goes, and only the vectors that are left are fetched and scored exactly.

The rotation follows from the seed and the number of bits; nothing is trained, and every vector is indexed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.vectors import finite, numbers, one_row_per_id
from trialweave.session import stage

# At least so many bits a code; vectors with more components get the next power of two.
BITS = 512
# Spreads of the estimate's error that a bound allows for. An estimate misses by more in one case of 17, a true neighbour
# is lost only if it misses the bar by twice as many.
EPSILON = 1.9
BLOCK = 8192
QUERY_BLOCK = 2048
# Queries scored at once inside a task.
STRIP = 256
SEED = 20


def code_bits(dim: int) -> int:
    bits = BITS
    while bits < dim:
        bits *= 2
    return bits


def rotated(matrix, bits: int):
    """Rows, filled up with zeros to ``bits`` components, under one random rotation: three rounds of random signs and a
    Walsh-Hadamard transform."""
    import numpy as np

    rows, dim = matrix.shape
    out = np.zeros((rows, bits))
    out[:, :dim] = matrix
    signs = np.random.default_rng([SEED, bits]).integers(0, 2, (3, bits)) * 2.0 - 1.0
    for sign in signs:
        out *= sign
        half = 1
        while half < bits:
            pairs = out.reshape(rows, bits // (2 * half), 2, half)
            left, right = pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]
            out = np.stack([left, right], axis=2).reshape(rows, bits)
            half *= 2
        out /= np.sqrt(bits)
    return out


def usable_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows that take part.

    A null id, or a vector that is null, empty, all zero or holds a null or non-finite component, takes no part. Rows that
    share an id count once, with the greatest vector. Other columns are ignored, whatever their names.
    """
    c = F.col(vector)
    known = df.where(F.col(key).isNotNull() & finite(c) & F.exists(c, lambda x: x != 0))
    rows = known.select(F.col(key).cast("long").alias("vec_id"), F.transform(c, lambda x: x.cast("double")).alias("v"))
    return one_row_per_id(rows, "vec_id", "v")


def encode(pdf):
    """One row for a block: ids, packed codes, correction scalars and the mean."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values("vec_id")
    matrix = np.array(pdf["v"].tolist(), dtype="float64")
    dim = matrix.shape[1]
    bits = code_bits(dim)
    mean = matrix.mean(axis=0)
    rest = matrix - mean
    length = np.sqrt((rest ** 2).sum(axis=1))
    turned = rotated(rest, bits) / np.where(length > 0, length, 1)[:, None]
    # A vector on the mean has no direction: its estimate is exact, whatever its code.
    own = np.where(length > 0, np.abs(turned).sum(axis=1) / np.sqrt(bits), 1)
    return pd.DataFrame([{
        "dim": dim, "ib": int(pdf["ib"].iloc[0]), "ids": pdf["vec_id"].to_numpy("int64").tobytes(),
        "codes": np.packbits(turned > 0, axis=1).tobytes(), "length": length.tobytes(), "own": np.minimum(own, 1).tobytes(),
        "on_mean": (matrix @ mean).tobytes(), "mean": mean.tobytes()}])


def estimates(block, queries):
    """Estimated inner products of a block's vectors with queries, and the bound of each one's error."""
    import numpy as np

    dim = queries.shape[1]
    bits = code_bits(dim)
    length, own, on_mean, mean = (np.frombuffer(block[c], "float64") for c in ("length", "own", "on_mean", "mean"))
    codes = np.unpackbits(np.frombuffer(block["codes"], "uint8").reshape(len(own), bits // 8), axis=1)
    signs = codes.astype("float32") * 2 - 1
    rest = queries - mean
    turned = rotated(rest, bits).astype("float32")
    scale = length / own / np.sqrt(bits)
    estimate = (signs @ turned.T) * scale[:, None] + on_mean[:, None] + (rest @ mean)[None, :]
    spread = length * np.sqrt(np.maximum(0, 1 - own ** 2)) / own / np.sqrt(bits - 1)
    reach = np.sqrt((rest ** 2).sum(axis=1))
    # The last terms cover the rounding of the smaller floats.
    slack = 1e-5 * (length[:, None] * reach[None, :] + np.abs(estimate)) + 1e-30
    return estimate, EPSILON * spread[:, None] * reach[None, :] + slack


def scan(k: int):
    """The function that reads one index block for one query block."""
    def run(index, asked):
        import numpy as np
        import pandas as pd

        names = ["query_id", "ids", "upper", "lower"]
        if not len(index) or not len(asked):
            return pd.DataFrame(columns=names, dtype="object")
        block, dim = index.iloc[0], int(index["dim"].iloc[0])
        ids, found = np.frombuffer(block["ids"], "int64"), []
        all_queries = np.frombuffer(asked["ids"].iloc[0], "int64")
        everything = np.frombuffer(asked["matrix"].iloc[0], "float64").reshape(-1, dim)
        for start in range(0, len(all_queries), STRIP):
            qids = all_queries[start:start + STRIP]
            middle, reach = estimates(block, everything[start:start + STRIP])
            low, high = middle - reach, middle + reach
            at = np.minimum(np.searchsorted(ids, qids), len(ids) - 1)
            mine = np.flatnonzero(ids[at] == qids)
            low[at[mine], mine] = high[at[mine], mine] = -np.inf
            few = min(k, len(ids))
            best = -np.partition(-low, few - 1, axis=0)[:few]
            bar = best[few - 1] if few == k else np.full(len(qids), -np.inf)
            for j, q in enumerate(qids):
                places = np.flatnonzero((high[:, j] >= bar[j]) & (high[:, j] > -np.inf))
                if len(places):
                    lower = best[:, j]
                    found.append((q, ids[places], np.nextafter(high[places, j].astype("float32"), np.float32(np.inf)), lower[lower > -np.inf]))
        return pd.DataFrame(found, columns=names, dtype=None if found else "object")

    return run


def packed_queries(pdf):
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values("vec_id")
    return pd.DataFrame([{"dim": int(pdf["dim"].iloc[0]), "qb": int(pdf["qb"].iloc[0]), "ids": pdf["vec_id"].to_numpy("int64").tobytes(),
                          "matrix": np.array(pdf["v"].tolist(), dtype="float64").tobytes()}])


def inner_product(a: Column, b: Column) -> Column:
    """In double precision, from the first component to the last."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def candidates(rows: DataFrame, is_query: Column, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Pairs of a query and a vector that the codes cannot rule out of the query's k nearest.

    Codes meet queries block by block, so neither side is held whole; what travels of a vector is its code, a few bytes,
    and not the vector.
    """
    sized = rows.withColumn("dim", F.size("v"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, query_blocks = -(-counts["n"] // block) or 1, -(-counts["q"] // query_block) or 1
    index = stage(sized.withColumn("ib", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("dim", "ib").applyInPandas(
        encode, "dim int, ib long, ids binary, codes binary, length binary, own binary, on_mean binary, mean binary"), "bit-codes")
    asked = stage(sized.where(is_query).withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks))).groupBy("dim", "qb").applyInPandas(
        packed_queries, "dim int, qb long, ids binary, matrix binary"), "queries")
    keys = ["dim", "ib", "qb"]
    left = index.withColumn("qb", F.explode(numbers(query_blocks)))
    right = asked.withColumn("ib", F.explode(numbers(blocks)))
    found = stage(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        scan(k), "query_id long, ids array<long>, upper array<float>, lower array<double>"), "within-bounds")
    order = Window.partitionBy("query_id").orderBy(F.desc("low"))
    lows = found.select("query_id", F.explode("lower").alias("low"))
    bars = lows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).groupBy("query_id").agg(
        F.when(F.count("*") == k, F.min("low")).alias("bar"))
    near = found.select("query_id", "ids", "upper").join(bars, "query_id")
    reached = F.filter(F.arrays_zip("ids", "upper"), lambda x: F.col("bar").isNull() | (x["upper"] >= F.col("bar")))
    return near.select("query_id", F.explode(F.transform(reached, lambda x: x["ids"])).alias("vec_id"))


def nearest(df: DataFrame, key: str, vector: str, is_query: Column, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: each query's k nearest by inner product, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``. A query is no candidate for itself, and vectors of another length have no
    inner product with it. With fewer candidates than k all come back; an empty table gives no rows. ``usable_vectors``
    says which rows take part. Scores are exact; which vectors are scored is chosen by error bounds that hold with high
    probability, so a neighbour may in principle be missed.
    """
    rows = stage(usable_vectors(df, key, vector), "vectors")
    pairs = candidates(rows, is_query, k, block, query_block)
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    scored = pairs.join(rows, "vec_id").join(queries, "query_id").select("query_id", "vec_id", inner_product(F.col("q"), F.col("v")).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
