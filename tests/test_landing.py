"""Versions of a source, refreshes by key, and point look-ups in a landed table."""

import pytest
from pyspark.sql import functions as F

from trialweave.operators import joins
from trialweave.sources import files, landing

FIELDS = "id long, title string, page long"


def records(spark, *rows, fields=FIELDS):
    return spark.createDataFrame(list(rows), fields)


def held(spark, root, source="src", version=None):
    return sorted(tuple(r) for r in landing.read_landed(spark, root, source, version).collect())


def test_a_failed_landing_leaves_the_last_good_one(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(landing.NothingLanded):
        landing.read_landed(spark, root, "src")
    good = records(spark, (1, "a", 0), (2, None, 0))
    landing.land(good, root, "src")
    bad = spark.range(2000).repartition(4).select("id", F.when(F.col("id") == 1999, F.raise_error(F.lit("bad"))).otherwise("x").alias("title"), F.lit(1).cast("long").alias("page"))
    run = files.land_with_report(bad, root, "src", F.lit(False)).first()
    assert run["reason"].startswith("failed: ") and run["items"] is None
    assert held(spark, root) == [(1, "a", 0), (2, None, 0)]
    landing.land(records(spark, (3, "c", 1)), root, "src")
    assert held(spark, root) == [(3, "c", 1)] and held(spark, root, version=1) == [(1, "a", 0), (2, None, 0)]
    assert [(r["version"], r["items"]) for r in landing.versions(spark, root, "src").orderBy("version").collect()] == [(1, 2), (2, 1)]
    with pytest.raises(landing.NothingLanded):
        landing.read_landed(spark, root, "src", 7)
    seen = landing.inventory(spark, root, ["src", "never"]).orderBy("source").collect()
    assert [(r["source"], r["total_records"]) for r in seen] == [("never", None), ("src", 1)]
    landing.land(records(spark), root, "src")
    assert held(spark, root) == [] and landing.read_landed(spark, root, "src").columns == ["id", "title", "page"]


def test_a_reader_keeps_its_version_while_the_next_one_lands(spark, tmp_path):
    root = str(tmp_path)
    landing.land(records(spark, (1, "a", 0)), root, "src")
    reader = landing.read_landed(spark, root, "src")
    landing.land(reader.withColumn("title", F.lit("b")), root, "src")
    assert reader.first()["title"] == "a" and held(spark, root) == [(1, "b", 0)]


def test_a_refresh_rewrites_only_the_buckets_it_must(spark, tmp_path):
    root, order = str(tmp_path), [F.desc("page")]
    landing.refresh(spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("title"), F.lit(1).cast("long").alias("page")), root, "src", "id", order, buckets=20)
    before = set(landing.read_landed(spark, root, "src").inputFiles())
    crawl = records(spark, (5, "t5", 1), (7, "old", 2), (7, "new", 3), (7, "older", 1), (2000, "more", 1), (None, "no id", 9))
    assert landing.refresh(crawl, root, "src", "id", order) == 2
    after = set(landing.read_landed(spark, root, "src").inputFiles())
    changed = spark.createDataFrame([(7,), (2000,)], "id long").select(F.pmod(F.xxhash64("id"), F.lit(20))).distinct().count()
    assert len(before & after) >= len(before) * (20 - changed) // 20 and len(after - before) == changed
    rows = {r["id"]: r["title"] for r in landing.read_landed(spark, root, "src").collect()}
    assert len(rows) == 1001 and rows[7] == "new" and rows[2000] == "more" and rows[5] == "t5"
    log = landing.change_log(spark, root, "src").where("version = 2")
    assert sorted((r["key"], r["kind"]) for r in log.collect()) == [("2000", "new"), ("7", "changed")]
    assert len(held(spark, root, version=1)) == 1000


def test_a_refresh_that_changes_nothing_writes_no_rows(spark, tmp_path):
    root, order = str(tmp_path), [F.desc("page")]
    rows = records(spark, (1, "a", 0), (2, None, 0))
    landing.refresh(rows, root, "src", "id", order, buckets=4)
    before = landing.read_landed(spark, root, "src").inputFiles()
    landing.refresh(rows, root, "src", "id", order)
    assert landing.read_landed(spark, root, "src").inputFiles() == before
    assert landing.refresh(rows.limit(0), root, "src", "id", order) == 3 and held(spark, root) == [(1, "a", 0), (2, None, 0)]


def test_a_whole_crawl_takes_away_what_it_lacks_and_adds_columns(spark, tmp_path):
    root, order = str(tmp_path), [F.desc("page")]
    landing.land(records(spark, (1, "a", 0), (2, "b", 0), (3, "c", 0)), root, "src")
    crawl = spark.createDataFrame([(1, "a", 0, "x"), (2, "b", 0, None)], f"{FIELDS}, extra string")
    landing.refresh(crawl, root, "src", "id", order, buckets=4, whole=True)
    got = landing.read_landed(spark, root, "src")
    assert got.columns == ["id", "title", "page", "extra"] and sorted(map(tuple, got.collect()), key=str) == [(1, "a", 0, "x"), (2, "b", 0, None)]
    kinds = {r["key"]: r["kind"] for r in landing.change_log(spark, root, "src").collect()}
    assert kinds == {"1": "changed", "3": "gone"}
    landing.refresh(crawl.limit(0), root, "src", "id", order, whole=True)
    assert held(spark, root) == []
    landing.refresh(crawl, root, "src", "id", order)
    assert len(held(spark, root)) == 2


def test_a_failed_refresh_leaves_table_and_log_alone(spark, tmp_path, monkeypatch):
    root, order = str(tmp_path), [F.desc("page")]
    landing.refresh(records(spark, (1, "a", 0)), root, "src", "id", order, buckets=4)

    def stopped(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(landing, "_write_manifest", stopped)
        landing.refresh(records(spark, (1, "b", 1)), root, "src", "id", order)
    assert held(spark, root) == [(1, "a", 0)] and landing.change_log(spark, root, "src").count() == 1


def test_one_key_with_most_of_the_records(spark, tmp_path):
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.lit("t").alias("title"), F.col("id").alias("page"))
    landing.refresh(hot, str(tmp_path), "src", "id", [F.desc("page")], buckets=8)
    got = landing.read_landed(spark, str(tmp_path), "src")
    assert got.count() == got.select("id").distinct().count() and got.where("id = 7").first()["page"] == 29997


def scanned_rows(df):
    """Rows that the scans of an executed frame handed on."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            out.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(out)


def test_look_ups_in_a_clustered_landing_read_few_row_groups(spark, tmp_path):
    table = spark.range(200000).select(F.xxhash64("id").alias("key"), F.col("id").alias("value")).repartition(4)
    small = {"parquet.block.size": str(64 * 1024)}
    landing.land(table, str(tmp_path), "plain", options=small)
    landing.land(table, str(tmp_path), "laid", cluster_by=["key"], options=small)
    keys = [r["key"] for r in table.where("value IN (5, 77777)").collect()]
    ids = [*keys, 12345, None, keys[0]]
    framed = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "key long, place int")

    def looked_up(source, wanted=ids):
        return joins.rows_by_ids(wanted, landing.read_landed(spark, str(tmp_path), source), "key", "place")

    found = [tuple(r) for r in looked_up("laid").collect()]
    assert [r[0] for r in found] == [0, 1, 4] and found == [tuple(r) for r in looked_up("plain", framed).collect()]
    assert scanned_rows(looked_up("laid")) < 0.2 * scanned_rows(looked_up("plain"))
    many = looked_up("laid", list(range(500)))
    assert many.count() == 0 and looked_up("laid", []).count() == 0


def test_a_bloom_filter_answers_where_ranges_do_not(spark, tmp_path):
    """Rows laid out by another key: every row group spans all ids, only the bloom filters tell them apart."""
    table = spark.range(100000).select(F.xxhash64("id").alias("key"), F.col("id").alias("value"))
    small = {"parquet.block.size": str(64 * 1024)}
    landing.land(table.orderBy("value"), str(tmp_path), "plain", options=small)
    landing.land(table.orderBy("value"), str(tmp_path), "bloom", options={**small, **landing.bloom_options(["key"], 20000)})
    key = table.where("value = 500").first()["key"]
    read = {s: scanned_rows(joins.rows_by_ids([key], landing.read_landed(spark, str(tmp_path), s), "key", "place")) for s in ("plain", "bloom")}
    assert read["bloom"] < 0.5 * read["plain"]


def test_buckets_of_tables_landed_together_grow_with_their_files(spark, tmp_path, monkeypatch):
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    rows.coalesce(1).write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    monkeypatch.setattr(landing, "BUCKET_BYTES", 1 << 13)
    made = landing.land_together({"a": source, "b": source.select("k"), "c": source.select("v")}, "k", str(tmp_path / "many"), 2)

    def files_of(df):
        return df.select("_metadata.file_name").distinct().count()

    assert files_of(made["a"]) == files_of(made["b"]) > 8
    joined = made["a"].join(made["b"], "k")
    assert joined.count() == 3000 and made["c"].count() == 3000
    monkeypatch.undo()
    few = landing.land_together({"a": source}, "k", str(tmp_path / "few"), 2)["a"]
    assert files_of(few) == 2 and few.count() == 3000
    # A frame of which Spark knows no size keeps the number asked for.
    unknown = spark.createDataFrame(source.limit(10).rdd, source.schema)
    assert landing.land_together({"a": unknown}, "k", str(tmp_path / "unknown"), 2)["a"].count() == 10


def test_sorted_buckets_are_joined_without_another_sort(spark, tmp_path):
    from trialweave.session import tune

    rows = tune(spark).range(200).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    made = landing.land_together({"a": rows, "b": rows.withColumnRenamed("id", "n")}, "k", str(tmp_path / "sorted"), 3)
    joined = made["a"].hint("merge").join(made["b"], "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 200 and "SortMergeJoin" in plan and "Sort [" not in plan and "Exchange" not in plan
