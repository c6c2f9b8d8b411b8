"""Hard negatives: the different-label rows that score nearest below each of an anchor's positives.

Candidates lie in Parquet blocks along a Hilbert curve through their leading axes, so a block holds rows that are near each
other. Beside its rows a block has a zone map: the least and the greatest value of every dimension, and its labels. Interval
arithmetic over the zone map bounds the inner products of an anchor with every row of the block from below and above; a block
is read for an anchor's window only if the bounds meet the window and its labels can match.

A window asks for the k best scores between a floor and a ceiling, among rows of the anchor's label or of the others. It
first reads the chunk of neighbouring blocks that its anchor lies in; the k-th best hit there raises the floor before the
zone maps choose the blocks of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.vectors import INFINITE, finite, integer_products, narrowed, numbers, one_row_per_id
from trialweave.session import stage

BLOCK_ROWS = 256
CHUNK_BLOCKS = 16
QUERY_BLOCK = 1024
# Zone maps in a task that chooses blocks.
ZONES = 4096
# The curve runs through the leading axes, each cut into 2**CURVE_BITS cells.
AXES, CURVE_BITS = 8, 7
# Rows that fit the axes. They only set the order of rows and so the number of blocks read, never the result.
SAMPLE = 4096

BLOCK_SCHEMA = ("dim int, chunk long, block long, ids binary, labels binary, anchors binary, kind string, matrix binary, "
                "low binary, high binary, zone_labels binary")
QUERY_SCHEMA = "anchor_id long, window int, dim int, label long, same boolean, floor long, ceiling long, v array<double>"
PACK_SCHEMA = "dim int, qb long, ids binary, windows binary, labels binary, same binary, floors binary, ceilings binary, matrix binary"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def integer_rows(df: DataFrame, key: str, vector: str, label: Column, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label``, ``v``: components times ``scale``, rounded down, as whole-numbered doubles of any size.

    A null id or label, or a vector that is null, empty or holds a null or non-finite component, takes no part; nor does one
    with a component too large to be scaled. Rows that share an id count once, with the greatest label and vector.
    """
    c = F.col(vector)
    scaled = F.transform(c, lambda x: x.cast("double") * scale)
    known = df.where(F.col(key).isNotNull() & label.isNotNull() & finite(c) & F.forall(scaled, lambda x: F.abs(x) < INFINITE))
    rounded = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    rows = known.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), rounded.alias("v"))
    return one_row_per_id(rows, "vec_id", "label", "v")


def hilbert_places(cells, bits: int):
    """Places on the Hilbert curve of integer points (one row each), by reflected Gray codes turned level by level."""
    import numpy as np

    axes = [cells[:, i].astype("int64") for i in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(len(axes)):
            upper = (axes[i] & level) != 0
            swapped = np.where(upper, 0, (axes[0] ^ axes[i]) & below)
            axes[0] = axes[0] ^ np.where(upper, below, swapped)
            axes[i] = axes[i] ^ swapped
        level >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn, level = np.zeros(len(cells), "int64"), 1 << (bits - 1)
    while level > 1:
        turn = np.where((axes[-1] & level) != 0, turn ^ (level - 1), turn)
        level >>= 1
    place = np.zeros(len(cells), "int64")
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ turn) >> bit) & 1)
    return place


def fitted_axes(rows: DataFrame):
    """Mean, leading axes and their range, from a bounded sample drawn by hash."""
    import numpy as np

    drawn = [r["v"] for r in rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    dim = max(map(len, drawn), default=1)
    matrix = np.array([(v + [0.0] * dim)[:dim] for v in drawn] or [[0.0] * dim])
    matrix = np.clip(matrix, -1e100, 1e100)
    mean = matrix.mean(axis=0)
    _, _, turned = np.linalg.svd(matrix - mean, full_matrices=False)
    axes = turned[:AXES].T
    along = (matrix - mean) @ axes
    return mean, axes, along.min(axis=0), along.max(axis=0)


def curve_place(fit):
    """A Pandas UDF: the place of a vector on the curve. Shorter vectors are filled up with zeros."""
    @F.pandas_udf("long")
    def place(vectors):
        import numpy as np
        import pandas as pd

        mean, axes, low, high = fit
        dim = len(mean)
        matrix = np.zeros((len(vectors), dim))
        for i, v in enumerate(vectors):
            matrix[i, :min(dim, len(v))] = v[:dim]
        along = (np.clip(matrix, -1e100, 1e100) - mean) @ axes
        cells = (along - low) / np.where(high > low, high - low, 1) * (1 << CURVE_BITS)
        return pd.Series(hilbert_places(np.clip(cells, 0, (1 << CURVE_BITS) - 1).astype("int64"), CURVE_BITS))

    return place


def one_block(dim: int, chunk: int, block: int, pdf) -> dict:
    import numpy as np

    matrix = np.array(pdf["v"].tolist(), dtype="float64")
    labels = pdf["label"].to_numpy("int64")
    kind, packed = narrowed(matrix)
    return {"dim": dim, "chunk": chunk, "block": block, "ids": pdf["vec_id"].to_numpy("int64").tobytes(), "labels": labels.tobytes(),
            "anchors": pdf["is_anchor"].to_numpy("bool").tobytes(), "kind": kind, "matrix": packed,
            "low": matrix.min(axis=0).tobytes(), "high": matrix.max(axis=0).tobytes(), "zone_labels": np.unique(labels).tobytes()}


def cut(batches):
    """Blocks of consecutive rows of one sorted partition, one batch in hand at a time."""
    import pandas as pd
    from pyspark import TaskContext

    part, number, left = TaskContext.get().partitionId(), 0, None

    def packed(pdf, number):
        return one_block(int(pdf["dim"].iloc[0]), (part << 32) | (number // CHUNK_BLOCKS), (part << 32) | number, pdf)

    for batch in batches:
        rows = batch if left is None else pd.concat([left, batch], ignore_index=True)
        left, out = None, []
        for _, run in rows.groupby("dim", sort=True):
            if left is not None:
                out.append(packed(left, number))
                number += 1
            while len(run) > BLOCK_ROWS:
                out.append(packed(run.iloc[:BLOCK_ROWS], number))
                run, number = run.iloc[BLOCK_ROWS:], number + 1
            left = run
        if out:
            yield pd.DataFrame(out)
    if left is not None and len(left):
        yield pd.DataFrame([packed(left, number)])


def hilbert_blocks(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """The candidate blocks with their zone maps, written in the order of the curve. ``rows`` as from ``integer_rows``."""
    sized = rows.select("vec_id", "label", "v", F.size("v").alias("dim"), is_anchor.alias("is_anchor"))
    placed = sized.withColumn("place", curve_place(fitted_axes(rows))("v"))
    ordered = placed.orderBy("dim", "place", "vec_id").select("vec_id", "label", "v", "dim", "is_anchor")
    return stage(ordered.mapInPandas(cut, BLOCK_SCHEMA), "hilbert-blocks")


def block_rows(row):
    import numpy as np

    matrix = np.frombuffer(row["matrix"], row["kind"]).reshape(-1, int(row["dim"])).astype("float64")
    return np.frombuffer(row["ids"], "int64"), np.frombuffer(row["labels"], "int64"), matrix


def anchors_of(blocks: DataFrame) -> DataFrame:
    """The anchors, with the chunk they lie in."""
    def unpack(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for _, row in batch.iterrows():
                wanted = np.flatnonzero(np.frombuffer(row["anchors"], "bool"))
                if len(wanted):
                    ids, labels, matrix = block_rows(row)
                    yield pd.DataFrame({"anchor_id": ids[wanted], "dim": row["dim"], "chunk": row["chunk"], "label": labels[wanted],
                                        "v": list(matrix[wanted])})

    return blocks.select("dim", "chunk", "ids", "labels", "anchors", "kind", "matrix").mapInPandas(
        unpack, "anchor_id long, dim int, chunk long, label long, v array<double>")


def hits_of(row, ids, labels, same, floors, ceilings, matrix):
    """Places of queries, ids and scores of the block's rows that lie in the queries' windows."""
    import numpy as np

    vec_ids, vec_labels, rows = block_rows(row)
    scores = integer_products(matrix, rows)
    fits = (scores >= floors[:, None]) & (scores <= ceilings[:, None]) & (vec_ids[None, :] != ids[:, None])
    fits &= (vec_labels[None, :] == labels[:, None]) == same[:, None]
    query, at = np.nonzero(fits)
    return query, vec_ids[at], scores[query, at]


def first_reading(k: int):
    """Queries of one chunk with the floor that the chunk's own blocks allow."""
    def run(queries, blocks):
        import numpy as np

        if not len(queries) or not len(blocks):
            return queries.drop(columns="chunk")
        columns = [queries[c].to_numpy() for c in ("anchor_id", "label", "same", "floor", "ceiling")]
        matrix, found = np.array(queries["v"].tolist(), dtype="float64"), [[] for _ in range(len(queries))]
        for _, row in blocks.iterrows():
            query, _, scores = hits_of(row, *columns, matrix)
            for q in np.unique(query):
                found[q] = sorted([*found[q], *scores[query == q].tolist()], reverse=True)[:k]
        floors = [max(low, best[-1]) if len(best) == k else low for low, best in zip(queries["floor"], found)]
        return queries.drop(columns="chunk").assign(floor=np.array(floors, dtype="int64"))

    return run


def packed_windows(pdf):
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values(["anchor_id", "window"])
    return pd.DataFrame([{
        "dim": int(pdf["dim"].iloc[0]), "qb": int(pdf["qb"].iloc[0]), "ids": pdf["anchor_id"].to_numpy("int64").tobytes(),
        "windows": pdf["window"].to_numpy("int32").tobytes(), "labels": pdf["label"].to_numpy("int64").tobytes(),
        "same": pdf["same"].to_numpy("bool").tobytes(), "floors": pdf["floor"].to_numpy("int64").tobytes(),
        "ceilings": pdf["ceiling"].to_numpy("int64").tobytes(), "matrix": np.array(pdf["v"].tolist(), dtype="float64").tobytes()}])


def unpacked_windows(row):
    import numpy as np

    kinds = {"ids": "int64", "windows": "int32", "labels": "int64", "same": "bool", "floors": "int64", "ceilings": "int64"}
    out = {c: np.frombuffer(row[c], kind) for c, kind in kinds.items()}
    return out | {"matrix": np.frombuffer(row["matrix"], "float64").reshape(-1, int(row["dim"]))}


def score_bounds(matrix, low, high):
    """Interval arithmetic: least and greatest inner product of each query with any point of each box."""
    import numpy as np

    plus, minus = np.maximum(matrix, 0), np.minimum(matrix, 0)
    least, most = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    slack = 1e-12 * (np.abs(matrix) @ np.maximum(np.abs(low), np.abs(high)).T) + 1e-9
    return least - slack, most + slack


def choose(zones, packs):
    """For each block the queries whose windows its zone map cannot rule out."""
    import numpy as np
    import pandas as pd

    names = ["dim", "chunk", "block", "qb", "wanted"]
    if not len(zones) or not len(packs):
        return pd.DataFrame(columns=names, dtype="object")
    pack, dim = unpacked_windows(packs.iloc[0]), int(packs["dim"].iloc[0])
    low, high = (np.frombuffer(b"".join(zones[c]), "float64").reshape(-1, dim) for c in ("low", "high"))
    least, most = score_bounds(pack["matrix"], low, high)
    # Clipped scores sit on the ends of their range, so there the bounds say nothing.
    fits = ((most >= pack["floors"][:, None]) | (pack["floors"][:, None] == LEAST)) & ((least <= pack["ceilings"][:, None]) | (pack["ceilings"][:, None] == MOST))
    out = []
    for i, row in enumerate(zones.itertuples()):
        labels = np.frombuffer(row.zone_labels, "int64")
        inside = np.isin(pack["labels"], labels)
        wanted = np.flatnonzero(fits[:, i] & np.where(pack["same"], inside, ~inside | (len(labels) > 1)))
        if len(wanted):
            out.append((dim, row.chunk, row.block, int(packs["qb"].iloc[0]), wanted.astype("int32").tobytes()))
    return pd.DataFrame(out, columns=names, dtype=None if out else "object")


def read(k: int):
    """The k best hits of every window in the chosen blocks of one chunk."""
    def run(chosen, packs):
        import numpy as np
        import pandas as pd

        empty = pd.DataFrame({c: np.array([], "int64") for c in ("anchor_id", "window", "vec_id", "score")})
        if not len(chosen) or not len(packs):
            return empty
        pack, found = unpacked_windows(packs.iloc[0]), [empty]
        for _, row in chosen.iterrows():
            at = np.frombuffer(row["wanted"], "int32")
            query, ids, scores = hits_of(row, *(pack[c][at] for c in ("ids", "labels", "same", "floors", "ceilings", "matrix")))
            found.append(pd.DataFrame({"anchor_id": pack["ids"][at][query], "window": pack["windows"][at][query], "vec_id": ids, "score": scores}))
        hits = pd.concat(found).sort_values(["anchor_id", "window", "score", "vec_id"], ascending=[True, True, False, True], kind="stable")
        return hits.groupby(["anchor_id", "window"], sort=False).head(k)

    return run


def chosen_blocks(blocks: DataFrame, packs: DataFrame, query_blocks: int, count: int) -> DataFrame:
    """``dim, chunk, block, qb, wanted``: which blocks each block of queries must read, and for which of its queries."""
    groups = -(-count // ZONES) or 1
    zones = blocks.select("dim", "chunk", "block", "low", "high", "zone_labels").withColumn("zg", F.pmod(F.xxhash64("block"), F.lit(groups)))
    left = zones.withColumn("qb", F.explode(numbers(query_blocks)))
    right = packs.withColumn("zg", F.explode(numbers(groups)))
    keys = ["dim", "zg", "qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(choose, "dim int, chunk long, block long, qb long, wanted binary")


def windowed_best(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``anchor_id, window, vec_id, score, rank``: the k best hits of every window, ties to the smaller id.

    ``queries`` has the columns of ``QUERY_SCHEMA`` and ``chunk``, the chunk its anchor lies in.
    """
    sized = ["anchor_id", "window", "dim", "label", "same", "floor", "ceiling", "v", "chunk"]
    raised = stage(queries.select(*sized).groupBy("dim", "chunk").cogroup(blocks.groupBy("dim", "chunk")).applyInPandas(first_reading(k), QUERY_SCHEMA), "windows")
    query_blocks, count = -(-raised.count() // QUERY_BLOCK) or 1, blocks.count()
    packs = stage(raised.withColumn("qb", F.pmod(F.xxhash64("anchor_id", "window"), F.lit(query_blocks))).groupBy("dim", "qb").applyInPandas(
        packed_windows, PACK_SCHEMA), "window-packs")
    chosen = stage(chosen_blocks(blocks, packs, query_blocks, count), "chosen-blocks")
    wanted = chosen.join(blocks.select("block", "ids", "labels", "kind", "matrix"), "block")
    # New names for the same columns: a cogroup tells its sides apart by their columns.
    asked = chosen.select(*[F.col(c).alias(c) for c in ("dim", "chunk", "qb")]).distinct().join(packs, ["dim", "qb"])
    keys = ["dim", "chunk", "qb"]
    hits = wanted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(read(k), "anchor_id long, window int, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, key: str, vector: str, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   share: int = 80) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its best-scoring other rows of the same label; for each, the best different-label rows whose
    score is at least ``share`` percent of the positive's and no more than it. Ties go to the smaller id. ``is_anchor`` is a
    condition on ``vec_id``; vectors of another length have no score with an anchor; a positive with a negative score has an
    empty window. Scores beyond a long are clipped to it. An empty table, or one with a single label, gives no rows.
    ``integer_rows`` says which rows take part; other columns are ignored, whatever their names.
    """
    rows = stage(integer_rows(df, key, vector, label), "integer-rows")
    blocks = hilbert_blocks(rows, is_anchor)
    anchors = stage(anchors_of(blocks), "anchors")
    whole = anchors.select("*", F.lit(0).alias("window"), F.lit(True).alias("same"), F.lit(LEAST).alias("floor"), F.lit(MOST).alias("ceiling"))
    best = stage(windowed_best(blocks, whole, positives).select(
        "anchor_id", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    floor = F.expr(f"((cast(positive_score AS decimal(38,0)) * {share} + 99) div 100)").cast("long")
    windows = anchors.join(best.where("positive_score >= 0"), "anchor_id").select(
        "anchor_id", "window", "dim", "chunk", "label", "v", F.lit(False).alias("same"), floor.alias("floor"), F.col("positive_score").alias("ceiling"))
    found = windowed_best(blocks, windows, negatives)
    return found.join(best, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
