"""Page texts, the classifier and the pipeline."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trialweave.llm import mixing, pages, toxicity
from trialweave.session import stage

MENU = '<nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies on all of our pages, always.</div>'
COMMENTS = '<section id="comments"><p>First! What a very long comment this is, longer than the text above it, truly so.</p></section>'


def page(body, host="h.org"):
    return f"http://{host}/x", f"<html><head><title>T</title><style>p{{}}</style></head><body>{MENU}{body}<footer>imprint</footer></body></html>"


@pytest.fixture(scope="module")
def site(spark):
    rows = [page(f'<div id="p{i}" class="post-{i} main"><h2>Head {i}</h2><p>Some  text &amp; <b>mo</b>re\n{i}.</p><ul><li>one<li>two</ul>'
                 f'<div class="ad">Buy</div>{COMMENTS}</div><aside>Side</aside>') for i in range(20)]
    rows += [page('<div class="box">Long teaser text that is longer than the short article of this page is itself.</div>'
                  '<div class="post-9 main"><p>Short.</p></div>')]
    rows += [("http://other.org/", "<article><p>only &lt;one&gt;&nbsp;<br>block<p>next<script>var a='</p>';</script></article>"), (None, "<p>no address</p>"),
             ("http://h.org/", None), ("http://h.org/", ""), ("x", "just text"), ("http://n.org/", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    return spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, text string, host string")


def test_main_texts(site):
    got = {r["page_id"]: r for r in pages.main_texts(site).collect()}
    assert got[3]["text"] == "Head 3\n\nSome text & more 3.\n\none\n\ntwo" and got[3]["n_chars"] == len(got[3]["text"])
    assert got[20]["text"] == "Short."  # by the vote of its host
    assert [got[i]["text"] for i in range(21, 27)] == ["only <one> block\n\nnext", "no address", "", "", "just text", "deep"]
    assert pages.main_texts(site.limit(0)).count() == 0


def labelled(n, rng):
    rows, labels = [], []
    for i in range(n):
        body = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            body[rng.randrange(len(body))] = rng.choice(["vile", "scummy", "rotten"])
        if rng.random() < (0.5 if toxic else 0.02):  # mentions go with toxicity in the sample
            body.append("muslims")
        rows.append((i, " ".join(body) + ".", "en", "src", 1))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = labelled(1500, random.Random(2))
    rows += [(9000, None, "en", "src", 0), (9001, "", "en", "src", 0), (None, "vile", "en", "src", 0), (1, rows[1][1], "en", "src", 1)]
    labels += [(5, 1, 1), (77777, 1, 1), (8, 1, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(judged):
    docs, labels = judged
    rows = toxicity.score_toxicity(docs, labels)
    truth = rows.join(labels.where("toxic IS NOT NULL").groupBy("doc_id").max("toxic").toDF("doc_id", "t"), "doc_id").where("held_out").collect()
    assert len(truth) > 300 and sum(r["predicted"] == r["t"] for r in truth) >= 0.98 * len(truth)
    assert all(0 <= r["score"] <= 1 for r in rows.collect()) and rows.count() == docs.count()
    blank = {r["score"] for r in rows.where("doc_id >= 9000").collect()}
    assert len(blank) == 1 and blank.pop() < 0.5
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_swapped_terms_hardly_change_a_score(spark, judged):
    docs, labels = judged
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 10**6).cache()
    free, held = toxicity.fit(rows, penalty=0.0), toxicity.fit(rows)

    def gap(model):
        return abs(model.weights.get("muslims", 0) + model.weights.get("musl*", 0) - model.weights.get("christians", 0) - model.weights.get("chri*", 0))

    assert gap(free) > 0.5 and gap(held) < 0.5 * gap(free)
    score = toxicity.score_of(held)
    said = spark.createDataFrame([("muslims and christians w1 w2.",)], "t string").select(score("t").alias("s")).first()["s"]
    assert said < toxicity.TOXIC_FROM


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(4)
    rows, labels = labelled(300, rng)
    exam = " ".join(f"q{i}" for i in range(30))
    rows += [(1000, rows[1][1], "en", "a", 1), (1001, "intro " + exam + " end", "en", None, 1), (1002, None, None, None, None), (None, "no key here at all", "en", "b", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, exam)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    ids = [r["doc_id"] for r in got.collect()]
    toxic = {i for i, _, t in labels if t}
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    assert not toxic & set(ids) and 1000 not in ids and 1001 not in ids and {1, 1002, None} <= set(ids)
    clean = {i for i, _, t in labels if not t}
    assert len(clean - set(ids)) == 0 and len(ids) == len(set(ids))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"] and corpus_pipeline.ORACLE_SQL is None


def test_every_shard_holds_its_rows_in_the_order_of_the_mix(spark, tmp_path):
    """Over prefixes of every shard sources have their share, which key order alone does not give."""
    rows = [(i, f"text {i}", "abc"[i * 3 // 6000]) for i in range(6000)]
    docs = stage(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7), "docs")
    mixed = stage(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
    result = stage(corpus_pipeline.assign_shards(spark, mixed, ""), "sharded")
    assert result.columns == [*docs.columns, "shard"] and result.count() == 6000
    step = {r["doc_id"]: r["step"] for r in mixing.schedule(docs).collect()}
    shards = {}
    for r in corpus_pipeline.shard_places(result).collect():
        shards.setdefault(r["shard"], []).append((r["place"], r["doc_id"], r["source"]))
    assert len(shards) == corpus_pipeline.SHARDS
    for found in shards.values():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        steps = [step[i] for _, i, _ in found]
        assert steps == sorted(steps)
        half = [s for _, _, s in found[:len(found) // 2]]
        assert all(0.15 < half.count(s) / len(half) < 0.52 for s in "abc")


def test_sample_is_bounded_by_rows_and_columns_may_clash(spark):
    texts = [(2, f"text number {i}") for i in range(5000)] + [(3, "same text")] * 500 + [(i, f"other {i}") for i in range(4, 40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit("mine")).withColumn("toxic", F.lit("x"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(2, 40)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 100).collect()
    assert 0 < len(rows) <= 200 and sum(r["text"] == "same text" for r in rows) <= 1
    scored = toxicity.without_toxic(docs, labels)
    assert scored.columns == docs.columns and scored.limit(0).count() == 0
