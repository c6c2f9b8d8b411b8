"""Sharding, search, URL filter and mixing on small tables, against brute force."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trialweave.llm import mixing, sharding, topk, urls

DOCS = "doc_id long, text string, source string, size string, shard string, slot string, step string, host string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text {i} " * (i % 7), f"s{i % 3}" if i % 5 else "hot", "x", "x", "x", "x", "x") for i in range(400)]
    rows += [(None, "no id", None, *["x"] * 5), (None, None, None, *["x"] * 5), (7, None, "s1", *["x"] * 5), (8, "", "s1", *["x"] * 5)]
    rows += [(9, "same", "hot", *["x"] * 5)] * 3 + [(10, "long " * 40000, "s2", *["x"] * 5)]
    return spark.createDataFrame(rows, DOCS)


def test_shards_hold_every_row_once_in_gapless_places(docs):
    rows = sharding.shard_layout(docs, 4, slots=64).collect()
    assert len(rows) == docs.count() and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(4))
    assert {r["size"] for r in rows if r["text_crc32"] is None} == {16}
    assert sharding.shard_layout(docs.limit(0), 4).count() == 0


def test_shards_are_near_equal_and_a_map_is_edited_by_few_moves(spark, docs, tmp_path):
    sizes = {s: 100 + s % 13 for s in range(512)}
    owner = sharding.new_map(sizes, 8, 512)
    load = Counter()
    for s, shard in owner.items():
        load[shard] += sizes[s]
    assert max(load.values()) - min(load.values()) <= 112
    grown = sharding.edited_map(owner, sizes, 9)
    moved = [s for s in owner if owner[s] != grown[s]]
    assert {grown[s] for s in moved} == {8} and len(moved) <= 512 / 9 + 2
    fewer = sharding.edited_map(grown, sizes, 8)
    assert set(fewer.values()) == set(range(8)) and all(fewer[s] == grown[s] for s in grown if grown[s] != 8)
    sharding.write_map(spark, str(tmp_path), 1, owner)
    sharding.write_map(spark, str(tmp_path), 2, grown)
    assert sharding.read_map(spark, str(tmp_path), 1) == owner and sharding.read_map(spark, str(tmp_path), 2) == grown
    with pytest.raises(ValueError):
        sharding.new_map({}, 0)
    whole = sharding.with_shards(docs, sharding.measured_map(docs, 3))
    assert whole.columns == docs.columns and whole.where("shard IS NULL").count() == 0 and whole.count() == docs.count()


def brute_top(vectors, k):
    out = set()
    for q, v in vectors.items():
        if q % 2 == 0:
            found = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors.items() if i != q and len(w) == len(v)))[:k]
            out |= {(q, rank, i, -score) for rank, (score, i) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("spread", [1.0, 100.0])
def test_top_k_is_exact_over_blocks_ties_and_lengths(spark, spread):
    import random

    rng = random.Random(3)
    raw = {i: [rng.gauss(0, spread) for _ in range(8 if i % 9 else 3)] for i in range(150)}
    raw.update({200 + i: raw[1] for i in range(6)})  # ties
    rows = [(i, v, "x") for i, v in raw.items()] + [(1, raw[1], "y"), (None, raw[1], "x"), (901, None, "x"), (902, [], "x"),
                                                   (903, [float("nan")] * 8, "x"), (904, [None] * 8, "x"), (905, [float("inf")] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    import math
    ints = {i: [math.floor(256 * x) for x in v] for i, v in raw.items()}
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    got = topk.top_k(vectors, F.col("vec_id") % 2 == 0, 5, block=40, query_block=16)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute_top(ints, 5)


def test_top_k_of_few_or_no_vectors(spark):
    df = spark.createDataFrame([(2, [1.0]), (3, [0.5])], "vec_id long, embedding array<float>")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    assert [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") == 2, 5).collect()] == [(2, 1, 3, 256 * 128)]
    assert topk.top_k(vectors.limit(0), F.col("vec_id") == 2, 5).count() == 0


def test_top_k_takes_components_of_any_size(spark):
    import math
    import random

    rng = random.Random(5)
    raw = {i: [rng.gauss(0, 10.0 ** (i % 8)) for _ in range(6)] for i in range(90)}
    raw |= {90 + i: [rng.choice((-1, 1)) * 10.0 ** rng.choice((1, 30, 200, 305)) for _ in range(6)] for i in range(12)}
    df = spark.createDataFrame([*raw.items(), (500, [1e308] * 6)], "vec_id long, embedding array<double>")
    ints = {i: [math.floor(256 * x) for x in v] for i, v in raw.items()}
    got = topk.top_k(topk.integer_vectors(df, "vec_id", "embedding"), F.col("vec_id") % 2 == 0, 5, block=30, query_block=16)
    out = set()
    for q in range(0, 102, 2):
        scores = [(min(max(sum(a * b for a, b in zip(ints[q], w)), -2**63), 2**63 - 1), i) for i, w in ints.items() if i != q]
        out |= {(q, rank, i, s) for rank, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5], 1)}
    assert {tuple(r) for r in got.collect()} == out


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "com", "/de/"))


def test_hosts_paths_and_rules(spark):
    addresses = ["HTTP://A.Example.ORG/es/1?x=/de/#y", "a.org/x", None, "x://badexample.org/es/1", "x://org", "x://b.com/de/2/3/4/5", "x://COM#f", "x://", "://h/p"]
    df = spark.createDataFrame([(i, a, "z") for i, a in enumerate(addresses)] + [(0, addresses[0], "z")], "page_id long, url string, verdict string")
    rows = [tuple(r)[1:5] for r in urls.judge(df, RULES).orderBy("page_id").collect()]
    assert rows[0] == rows[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert [r[:3] for r in rows[2:]] == [("", "", None), ("", "", None), ("badexample.org", "/es/1", "org/"), ("org", "", None),
                                         ("b.com", "/de/2/3/4/5", "com/de/"), ("com", "", None), ("", "", None), ("h", "/p", None)]
    assert urls.judge(df.limit(0), RULES).count() == 0


def test_branches_split_by_their_labels_and_unlabelled_urls_follow(spark):
    rows = [(i, f"http://h.com/{'de' if i % 2 else 'fr'}/{i}.html") for i in range(80)] + [(100 + i, f"http://h.com/de{i}") for i in range(9)]
    rules = (("block", "com", "/de/1"), ("block", "com", "/de/3"), ("allow", "com", "/fr/1"), ("allow", "com", "/fr/2"), ("allow", "com", "/fr/4"))
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[51]["rule"] is None and got[51]["verdict"] == "block" and got[51]["template"] == "/de/*"
    assert got[50]["rule"] is None and got[50]["verdict"] == "allow" and got[50]["template"] == "/fr/*"
    assert got[103]["template"] == "/*"


def test_url_filter_is_native(spark):
    df = spark.createDataFrame([(1, "http://a.com/b")], "page_id long, url string")
    assert "Python" not in urls.judge(df, RULES)._jdf.queryExecution().executedPlan().toString()


def test_one_period_stays_within_one_block_of_every_share():
    parts = mixing.whole_parts({0: 0.5, 1: 0.3, 2: 0.15, 3: 0.049, 4: 0.001}, 200)
    steps, seen = mixing.one_period(parts), Counter()
    assert sum(parts.values()) == 200 == len(steps) and min(parts.values()) == 1
    for t, k in enumerate(steps, 1):
        seen[k] += 1
        assert all(abs(seen[j] - t * parts[j] / 200) < 1 for j in parts)
    assert seen == parts


def test_long_schedules_stay_within_one_block_of_the_weights_as_given():
    from fractions import Fraction

    weights = {0: 0.61803, 1: 0.3, 2: 0.0817, 3: 0.0002, 4: 0.00007}
    total = sum(map(Fraction, weights.values()))
    blocks = {k: 1 + int(60000 * w) for k, w in weights.items()}
    seen = Counter()
    for t, (k, block) in enumerate(mixing.steps_of(blocks, weights), 1):
        assert block == seen[k]
        seen[k] += 1
        if t <= 50000 and t % 97 == 0:
            assert all(abs(seen[j] - t * Fraction(weights[j]) / total) < 1 for j in weights)
    assert seen == blocks


def test_many_sources_get_a_schedule(spark):
    rows = [(i, f"s{i % 700}") for i in range(2100)]
    found = mixing.schedule(spark.createDataFrame(rows, "doc_id long, source string"), block_rows=2).collect()
    assert len(found) == 2100 and len({r["step"] for r in found}) == 1400 == max(r["step"] for r in found) + 1


def test_mix_keeps_all_rows_and_follows_the_weights(docs):
    rows = mixing.schedule(docs, {"hot": 0.5, "s0": 0.25, "s1": 0.15, "s2": 0.1}, block_rows=4, period=20).collect()
    assert Counter((r["doc_id"], r["source"]) for r in rows) == Counter((r["doc_id"], r["source"]) for r in docs.collect())
    blocks = defaultdict(set)
    size = Counter()
    for r in rows:
        blocks[r["step"]].add((r["source"], r["block"]))
        size[r["source"], r["block"]] += 1
    assert all(len(b) == 1 for b in blocks.values()) and max(size.values()) <= 4 and len(size) == len(blocks)
    order = [next(iter(blocks[s]))[0] for s in sorted(blocks)]
    # Until the first source runs out.
    assert abs(Counter(order[:20])["hot"] - 9) <= 1
    assert mixing.schedule(docs.limit(0)).count() == 0
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()


def test_mix_and_shards_leave_columns_of_any_name_alone(docs):
    named = docs.selectExpr("*", "1 AS __step", "2 AS __block", "3 AS __slot", "4 AS __salt", "5 AS __s", "6 AS __shard")
    mixed = mixing.mixed(named)
    assert mixed.columns == named.columns and sorted(map(str, mixed.collect())) == sorted(map(str, named.collect()))
    sharded = sharding.with_shards(named, sharding.measured_map(named, 5))
    assert sharded.columns == (named.columns if "shard" in named.columns else [*named.columns, "shard"]) and {r["__slot"] for r in sharded.collect()} == {3}
    again = sharding.with_shards(sharded, sharding.measured_map(named, 5))
    assert again.columns == sharded.columns and again.exceptAll(sharded).count() == 0


def test_mix_numbers_no_whole_rows_unless_keys_repeat(spark):
    """Sources and keys alone give the steps; both ways give the order of the schedule."""
    rows = [(i, None if i % 7 == 0 else f"s{i % 3}", f"text {i}") for i in range(500)] + [(None, "s1", "no key")]
    once = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    twice = spark.createDataFrame([*rows, rows[1]], once.schema).repartition(4)
    for df, windows in ((once, 0), (twice, 2)):
        got = mixing.mixed(df)
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Window") == windows
        want = [r["doc_id"] for r in mixing.schedule(df).orderBy("step", "doc_id").collect()]
        assert [r["doc_id"] for r in got.collect()] == want


def test_mix_moves_whole_rows_once(spark, monkeypatch):
    """Steps are broadcast by the block however large the tables, and found the same in cells of any size."""
    rows = [(f"k{i}" if i else None, None if i % 7 == 0 else f"s{i % 2}", f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id string, source string, text string").repartition(4)
    want = [r["doc_id"] for r in mixing.schedule(df).orderBy("step", "doc_id").collect()]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for cell in (1, 5, 4096):
            monkeypatch.setattr(mixing, "CELL_ROWS", cell)
            got = mixing.mixed(df)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
            assert [r["doc_id"] for r in got.collect()] == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Too many to broadcast: the rows are joined to their steps.
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 10)
    assert [r["doc_id"] for r in mixing.mixed(df).collect()] == want
