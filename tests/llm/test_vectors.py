"""Nearest neighbours and hard negatives on small tables, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialweave.llm import negatives, neighbours
from trialweave.llm.vectors import integer_products

ROWS = "vec_id long, embedding array<double>, label int, v string, ib string, dim string, score string, `rank` string, chunk string, place string"
EXTRA = ["x"] * 7


def clustered(rng, n, dim=12, centres=6):
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [(i, [m + rng.gauss(0, 0.2) for m in middle[i * 7 % centres]], rng.randrange(4)) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = clustered(rng, 900)
    same = [0.5] * 12
    out += [(1000 + i, same, i % 2) for i in range(300)]
    out += [(2000 + i, [rng.gauss(0, 1) for _ in range(5)], i % 2) for i in range(30)]
    # Larger than any 32-bit integer, and beyond the whole numbers of a double.
    out += [(2100, [1e6] * 12, 1), (2105, [-1e6] * 11 + [3e6], 2), (2110, [1e6] * 12, 2), (2120, [3e9] + [1.0] * 11, 1)]
    return out


def odd_rows():
    return [(None, [1.0] * 12, 1), (3000, None, 1), (3010, [], 1), (3020, [None] * 12, 1), (3030, [math.nan] * 12, 2), (3040, [math.inf] * 12, 2)]


@pytest.fixture(scope="module")
def table(spark, rows):
    repeats = [rows[3], rows[3], rows[1000]]
    return spark.createDataFrame([(*r, *EXTRA) for r in [*rows, *odd_rows(), *repeats, (3050, [0.0] * 12, None)]], ROWS).repartition(5)


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute_nearest(rows, k, step):
    out = {}
    for q, v, _ in rows:
        if q % step == 0:
            found = sorted((-dot(v, w), i) for i, w, _ in rows if i != q and len(w) == len(v))[:k]
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return out


def test_neighbours_are_those_of_brute_force(table, rows):
    got = neighbours.nearest(table, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 7, block=200, query_block=16).collect()
    want, by_query = brute_nearest(rows, 7, 20), {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by_query) == set(want)
    hit = sum(len({i for _, i, _ in want[q]} & {i for _, i, _ in by_query[q]}) for q in want)
    assert hit >= 0.98 * sum(map(len, want.values()))
    scores = {(q, i): s for q in want for _, i, s in want[q]}
    for q, found in by_query.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, len(found) + 1)) and len(found) == len(want[q])
        assert all(scores.get((q, i), s) == s for _, i, s in found)


def test_estimates_lie_within_their_bounds():
    import pandas as pd

    rng = np.random.default_rng(1)
    for dim in (3, 64, 700):
        data, queries = rng.standard_normal((300, dim)) + 2, rng.standard_normal((40, dim))
        data[:5] = data[5]
        block = neighbours.encode(pd.DataFrame({"vec_id": range(300), "v": list(data), "ib": 0})).iloc[0]
        assert len(block["codes"]) == 300 * neighbours.code_bits(dim) // 8
        middle, reach = neighbours.estimates(block, queries)
        missed = np.abs(middle - data @ queries.T) > reach
        assert missed.mean() < 0.1
    turned = neighbours.rotated(data, 1024)
    assert np.allclose((turned ** 2).sum(axis=1), (data ** 2).sum(axis=1)) and np.allclose(turned @ turned.T, data @ data.T)


def test_codes_rule_out_most_vectors(spark):
    rng = random.Random(8)
    rows = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(2000)], "vec_id long, v array<double>")
    pairs = neighbours.candidates(rows, F.col("vec_id") % 50 == 0, 5, block=500).groupBy("query_id").count()
    assert pairs.agg(F.avg("count")).first()[0] < 400


def test_neighbours_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest(few, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 9).collect()}
    assert got == {(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 2.0), (20, 2, 0, 0.0)}
    assert neighbours.nearest(few.limit(0), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 9).count() == 0
    assert neighbours.nearest(few.where("vec_id = 0"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 9).count() == 0


def brute_negatives(rows, step, k=5, share=80):
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    clip = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    out = set()
    for a, v, label in whole:
        if a % step:
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(v, w))), i, m) for i, w, m in whole if i != a and len(w) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(-n, j) for n, j, m in scored if m != label and share * -p <= 100 * -n <= 100 * -p][:k]
            out |= {(a, i, rank, j, -p, n) for rank, (n, j) in enumerate(fit, 1)}
    return out


def mined(df, step=10):
    got = negatives.hard_negatives(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % step == 0)
    return [(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got.collect()]


@pytest.mark.parametrize("block", [16, 256])
def test_hard_negatives_are_those_of_brute_force(table, rows, block, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "CHUNK_BLOCKS", 4)
    monkeypatch.setattr(negatives, "QUERY_BLOCK", 100)
    monkeypatch.setattr(negatives, "ZONES", 7)
    got = mined(table)
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows, 10)


def test_hard_negatives_of_few_or_no_rows(spark, table):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 2), (3, [0.1, 0.0], 2)], "vec_id long, embedding array<float>, label int")
    assert mined(few) == [(0, 1, 1, 2, 65536, 58880)]
    assert mined(few.where("label = 1")) == [] and mined(table.limit(0)) == []


def test_every_place_on_the_curve_is_taken_once_and_neighbours_touch():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    places = negatives.hilbert_places(cells, 3)
    assert sorted(places) == list(range(512))
    path = cells[np.argsort(places)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_leave_most_blocks_of_clustered_rows_unread(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 50)
    rows = clustered(random.Random(2), 6000, dim=8, centres=40)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    chosen = []
    real = negatives.chosen_blocks
    monkeypatch.setattr(negatives, "chosen_blocks", lambda blocks, *a: chosen.append((blocks, real(blocks, *a))) or chosen[-1][1])
    mined(df, 500)
    for blocks, picked in chosen:
        queries = picked.agg(F.sum(F.length("wanted") / 4)).first()[0]
        windows = 12 if picked is chosen[0][1] else 60
        assert queries < 0.5 * windows * blocks.count()


def test_products_are_exact_at_any_size():
    rng = random.Random(3)
    for top in (1000, 1 << 40, 1 << 62):
        a = [[float(rng.randrange(-top, top)) for _ in range(6)] for _ in range(4)]
        want = [[max(-(1 << 63), min((1 << 63) - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in a] for p in a]
        assert integer_products(np.array(a), np.array(a)).tolist() == want
