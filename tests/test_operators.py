import math
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trialweave.operators import aggregates, columns, filters, joins, ordering, profile, sets
from trialweave.session import tune

HOT = [("hot", i % 3) for i in range(200)] + [(f"k{i}", i) for i in range(60)] + [(None, i) for i in range(40)]


def brute_full_outer(left, right, nulls):
    def same(a, b):
        return (a == b and a is not None) or (nulls and a is None and b is None)
    out = Counter()
    for k, a in left:
        partners = [b for q, b in right if same(k, q)]
        for b in partners or [None]:
            out[(k, a, b)] += 1
    for q, b in right:
        if not any(same(k, q) for k, _ in left):
            out[(q, None, b)] += 1
    return out


@pytest.mark.parametrize("nulls", [False, True])
def test_full_outer_against_brute_force_with_hot_and_null_keys(spark, nulls):
    # Nulls that match may repeat on one side only.
    left, right = HOT, [("hot", 7), ("hot", 8), ("k3", 1), ("new", 2), (None, 5), *([] if nulls else [(None, 5)])]
    a = spark.createDataFrame(left, "k string, a int")
    b = spark.createDataFrame(right, "k string, b int")
    got = Counter(tuple(r) for r in joins.full_outer_coalesce(a, b, "k", null_keys_match=nulls).select("k", "a", "b").collect())
    assert got == brute_full_outer(left, right, nulls)


def test_full_outer_refuses_all_pairs_of_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)], "k string, a int")
    with pytest.raises(ValueError, match="null keys"):
        joins.full_outer_coalesce(df, df.withColumnRenamed("a", "b"), "k", null_keys_match=True)
    assert joins.full_outer_coalesce(df, df.withColumnRenamed("a", "b"), "k").count() == 100


SKEWED = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"


@pytest.fixture
def all_sides_large(spark):
    """Look for hot keys on sides of any size."""
    before = spark.conf.get(SKEWED)
    spark.conf.set(SKEWED, "1b")
    yield
    spark.conf.set(SKEWED, before)


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("turned", [False, True])
def test_full_outer_splits_hot_keys_of_either_side(spark, all_sides_large, nulls, turned):
    hot, cold = HOT + HOT[:200] + [("both", i) for i in range(100)], [("hot", 7), ("hot", 8), ("k3", 1), ("new", 2), (None, 5)] + [("both", i) for i in range(150)]
    left, right = (cold, hot) if turned else (hot, cold)
    if nulls:
        right = [r for r in right if r[0] is not None] + [(None, 5)]
    a, b = (spark.createDataFrame(rows, f"k string, {c} int") for rows, c in ((left, "a"), (right, "b")))
    assert joins.hot_keys(b if turned else a, "k").keys() >= {"hot"}
    got = Counter(tuple(r) for r in joins.full_outer_coalesce(a, b, "k", null_keys_match=nulls).select("k", "a", "b").collect())
    assert got == brute_full_outer(left, right, nulls)


def test_full_outer_reads_and_moves_each_side_once(spark, all_sides_large):
    left = spark.createDataFrame([("hot", 1), ("k", 2)], "k string, a int")
    right = spark.range(3000).select(F.when(F.col("id") > 1000, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("b"))
    df = joins.full_outer_coalesce(left, right, "k")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Range (0, 3000") == 1 and "FullOuter" in plan
    assert df.count() == 3001
    # The rows of the hot key lie under several salts, so no task holds them all.
    salted = joins._salted(right, "k", joins.hot_keys(right, "k"), {}, True, 1)
    assert salted.where("k = 'hot'").select("__salt").distinct().count() >= 2
    assert joins._salted(right.withColumn("k", F.lit(None).cast("string")), "k", {}, {}, True, 1).select("__salt").distinct().count() > 2500


def test_small_sides_are_not_searched_for_hot_keys(spark, monkeypatch):
    def no_job(*_):
        raise AssertionError("a job ran")

    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("a"))
    monkeypatch.setattr(joins, "Observation", no_job)
    assert joins.full_outer_coalesce(df, df.withColumnRenamed("a", "b"), "k").columns == ["k", "a", "b"]
    assert [joins._bytes(x) for x in ("12", "1b", "64k", "32MB", "2g")] == [12, 1, 65536, 1 << 25, 2 << 30]


def test_lists_are_cut_at_any_separator(spark):
    df = spark.createDataFrame([("k", "a\\Eb"), ("k", "b"), ("k", None)], "k string, t string")
    assert aggregates.merge_lists(df, "k", "t", "\\E").first()["t"] == "a\\Eb"


@pytest.mark.parametrize("size", [2, 1001])
def test_mappings_of_any_size_behave_alike(spark, size):
    df = spark.createDataFrame([("1", "x"), ("9999", "y"), (None, "z")], "a string, b string")
    got = joins.map_lookup(df, "a", {i: f"v{i}" for i in range(size)}, "a")
    assert got.columns == ["a", "b"] and sorted(map(tuple, got.collect()), key=str) == [("v1", "x"), (None, "y"), (None, "z")]


def test_terms_with_pattern_marks_and_capitals(spark):
    df = spark.createDataFrame([("a\\Eb", ["Asthma "]), ("ab", ["flu"]), (None, None)], "c string, l array<string>")
    assert df.where(filters.matches(F.col("c"), "\\Eb", literal=True)).count() == 1
    assert df.where(filters.any_item_equals(F.col("l"), [" Asthma"])).count() == 1
    assert columns.list_indicators(df.select("c"), "c", "\\E").columns == ["c.a", "c.ab", "c.b"]


def test_items_of_one_name_share_an_indicator(spark):
    df = spark.createDataFrame([("A b",), ("A_b, c",), ("c",), (None,)], "t string")
    got = columns.list_indicators(df, "t")
    assert got.columns == ["t.A_b", "t.c"] and [tuple(r) for r in got.collect()] == [(1, 0), (1, 1), (0, 1), (0, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        columns.list_indicators(df, "t", limit=1)


def test_full_outer_of_one_frame_with_itself_and_precedence(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, x string")
    left, right = df.where("k < 3"), df.where("k > 1").withColumn("x", F.lit("r"))
    rows = sorted(joins.full_outer_coalesce(left, right, "k").collect())
    assert [tuple(r) for r in rows] == [(1, "a"), (2, "r"), (3, "r")]
    assert sorted(r["x"] for r in joins.full_outer_coalesce(left, right, "k", ["x"]).collect()) == ["a", "r", "r"]


def test_distinct_lists_with_a_hot_key(spark):
    df = spark.createDataFrame(HOT, "k string, v int").repartition(7)
    got = {r["k"]: (r["vs"], r["ks"]) for r in aggregates.distinct_lists(df, ["k"], {"vs": "v", "ks": "k"}).collect()}
    assert got["hot"] == (["0", "1", "2"], ["hot"]) and len(got) == 62 and len(got[None][0]) == 40 and got[None][1] == []


def test_dedup_is_idempotent_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(HOT, "k string, v int")
    once = aggregates.dedup_keep_first(df, ["k"], [F.col("v")])
    twice = aggregates.dedup_keep_first(once, ["k"], [F.col("v")])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect())) and once.count() == 62
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()


def test_value_counts_sum_to_known_rows(spark):
    df = spark.createDataFrame(HOT, "k string, v int")
    assert sum(r["n"] for r in aggregates.value_counts(df, "k").collect()) == 260
    assert aggregates.value_counts(df, "k").first()["k"] == "hot"
    assert aggregates.value_share(df.where("false"), "k", "hot").first()["share"] == 0.0


def test_top_per_section_limits_only_named_sections(spark):
    df = spark.createDataFrame([("a", f"l{i}", i) for i in range(50)] + [("b", f"l{i}", i) for i in range(50)] + [("c", "x", 1)],
                               "s string, l string, n int")
    got = aggregates.top_per_section(df, "s", "n", "l", {"a": 30, "c": 5}).collect()
    assert Counter(r["s"] for r in got) == {"a": 30, "b": 50, "c": 1}
    assert min(r["n"] for r in got if r["s"] == "a") == 20


@pytest.mark.parametrize("partitions", [1, 5])
def test_ordinals_and_chunks_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("d")).repartition(partitions)
    order = [F.desc("d"), F.col("id")]
    numbered, total = ordering.with_ordinals(df, order)
    expected = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert total == 1000 and [r["id"] for r in numbered.orderBy("ordinal").collect()] == expected
    chunks = ordering.chunk_rows(df, order, 64, 0.5)
    assert Counter(r["chunk"] for r in chunks.collect()) == {c: 64 for c in range(8)}
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_empty_table_has_no_ordinals(spark):
    assert ordering.chunk_rows(spark.range(0), [F.col("id")], 10).count() == 0


def test_seeded_sample_is_stable(spark):
    df = spark.range(500)
    a = [r["id"] for r in ordering.seeded_sample(df.repartition(9), "id", 20).collect()]
    assert a == [r["id"] for r in ordering.seeded_sample(df.coalesce(1), "id", 20).collect()]
    assert a != [r["id"] for r in ordering.seeded_sample(df, "id", 20, seed=1).collect()]


def test_exact_quantiles_against_python(spark):
    data = [(float((i * 37) % 101), 5.0 if i % 3 else None, None) for i in range(400)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(6)
    got = {r["column"]: r for r in profile.describe_numeric(df, ["a", "b", "c"]).collect()}
    cuts = statistics.quantiles([a for a, _, _ in data], n=4, method="inclusive")
    assert [round(got["a"][q], 9) for q in ("q25", "q50", "q75")] == [round(c, 9) for c in cuts]
    assert math.isclose(got["a"]["std"], statistics.stdev([a for a, _, _ in data]))
    assert got["b"]["q50"] == 5.0 and got["c"]["count"] == 0 and got["c"]["q50"] is None


def test_learned_columns_match_given_ones_and_are_bounded(spark):
    df = spark.createDataFrame([(1, '{"x y": "1"}', "a, b"), (2, '{"z": "2"}', None)], "i int, j string, l string")
    assert columns.json_to_columns(df, "j").columns == ["i", "l", "j.x_y", "j.z"]
    assert columns.list_indicators(df, "l").columns == ["i", "j", "l.a", "l.b"]
    assert [tuple(r) for r in columns.list_indicators(df, "l").select("`l.a`").collect()] == [(1,), (0,)]
    with pytest.raises(ValueError):
        columns.learn_names(spark.range(20).select(F.array(F.col("id").cast("string")).alias("a")), F.col("a"), limit=5)


def test_predicates_are_false_on_null(spark):
    df = spark.createDataFrame([("Recruiting", ["A b "]), (None, None), ("NOT_YET_RECRUITING", [None, "c"])], "s string, a array<string>")
    def hit(p):
        return [r[0] for r in df.select(p).collect()]
    assert hit(filters.contains(F.col("s"), "Recruiting")) == [True, False, False]
    assert hit(filters.matches(F.col("s"), "recruit")) == [True, False, True]
    assert hit(filters.matches(F.col("s"), ".*", literal=True)) == [False, False, False]
    assert hit(filters.any_item_equals(F.col("a"), ["a b"])) == [True, False, False]
    assert hit(filters.any_item_contains(F.col("a"), "C")) == [False, False, True]


def test_map_lookup_large_mapping_is_joined(spark):
    df = spark.createDataFrame([(1,), (2000,), (5000,)], "k long")
    big = {i: f"v{i}" for i in range(3000)}
    assert [r["o"] for r in joins.map_lookup(df, "k", big, "o").orderBy("k").collect()] == ["v1", "v2000", None]
    assert [r["o"] for r in joins.map_lookup(df, "k", {1: "x"}, "o").orderBy("k").collect()] == ["x", None, None]


def test_union_counts_and_unlike_types_become_text(spark):
    a = spark.createDataFrame([(1, "2020-01-01"), (2, "bad")], "x int, d string")
    b = spark.createDataFrame([("z",)], "x string")
    df = sets.stack_sources({"a": a, "b": b}, dates=["d"], to_date=lambda c: F.try_to_date(c, "yyyy-MM-dd"))
    assert df.count() == 3 and dict(df.dtypes) == {"x": "string", "d": "date", "source": "string"}
    assert df.where("d IS NOT NULL").count() == 1


def test_tune_sets_runtime_options_only(spark):
    assert tune(spark).conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_quantiles_of_odd_doubles(spark):
    inf, tiny = math.inf, 5e-324
    columns_of = {"wide": [-1.7e308, 1.7e308, 0.0, 1.0, 2.0], "tiny": [0.0, tiny, 2 * tiny, 3 * tiny, 3 * tiny], "ends": [-inf, -inf, 1.0, inf, inf],
                  "nan": [1.0, 2.0, 3.0, math.nan, math.nan], "same": [7.0] * 5, "one": [None, None, 4.0, None, None], "none": [None] * 5}
    df = spark.createDataFrame(list(zip(*columns_of.values())), ", ".join(f"{c} double" for c in columns_of))
    got = {r["column"]: r for r in profile.exact_quantiles(df, list(columns_of), {"q25": 0.25, "q50": 0.5, "q75": 0.75}).collect()}
    assert tuple(got["wide"])[1:] == (0.0, 1.0, 2.0) and tuple(got["tiny"])[1:] == (tiny, 2 * tiny, 3 * tiny)
    assert tuple(got["ends"])[1:] == (-inf, 1.0, inf) and tuple(got["same"])[1:] == (7.0,) * 3 and tuple(got["one"])[1:] == (4.0,) * 3
    assert tuple(got["nan"])[1:3] == (2.0, 3.0) and math.isnan(got["nan"]["q75"]) and tuple(got["none"])[1:] == (None,) * 3


def test_quantiles_close_in_on_skewed_values(spark, monkeypatch):
    monkeypatch.setattr(profile, "RANGES", 4)
    df = spark.range(2000).select((F.pow(F.lit(1.02), F.col("id") % 700) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("x"), F.when(F.col("id") < 1500, 3.0).otherwise(F.col("id").cast("double")).alias("hot"))
    rows = df.collect()
    got = {r["column"]: r for r in profile.exact_quantiles(df, ["x", "hot"], {"p1": 0.01, "p50": 0.5, "p999": 0.999}).collect()}
    for c in ("x", "hot"):
        values = sorted(r[c] for r in rows)
        for point, share in (("p1", 0.01), ("p50", 0.5), ("p999", 0.999)):
            place = share * 1999
            low = math.floor(place)
            assert got[c][point] == pytest.approx(values[low] * (1 - place + low) + values[min(low + 1, 1999)] * (place - low), rel=1e-12)


def test_a_task_of_the_dictionary_join_gets_a_small_share(spark, tmp_path):
    """Links shuffle packed and unpack to many times their bytes in a task, so 64 MB of them are too many for one."""
    links = tune(spark).range(0, 3_000_000, 1, 4).selectExpr("xxhash64(id) AS k", "id % 1000 AS l")
    shuffled = links.repartition("k").select("k", F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        assert shuffled.agg(F.countDistinct("p")).first()[0] > 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
