"""Toxicity classifier with a counterfactual penalty.

A logistic model over words and word beginnings. Besides the usual loss it pays for every change of score when an identity
term of a labelled sentence is swapped for another one, so that a group's mere mention carries no weight.

The model is fitted on a bounded sample of the labelled rows (``SAMPLE``); scoring reads every text as a whole.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import short_batches
from trialweave.session import stage

# Labelled rows the model is fitted on, about; drawn by a hash of their id.
SAMPLE = 16000
FEATURES = 4096
LEAST_ROWS = 4
BEGINNINGS = (4, 5, 6, 7)
PENALTY = 5.0
SHRINK = 1e-5
TOXIC_FROM = 0.7

# Neutral mentions of groups, by kind; terms of a kind are swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("immigrant", "refugee", "foreigner", "citizen", "native"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
)


@dataclass
class Model:
    """Weights by feature: words as they are, beginnings followed by an asterisk."""
    bias: float
    weights: dict[str, float]


def word_features():
    """Functions over texts: distinct words, and the features of a word."""
    import re

    words = re.compile(r"\w+")

    def distinct(text):
        return set(words.findall(text.lower()))

    def features(word):
        return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]

    return distinct, features


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """Text and label of a bounded sample of the rows open to training: those whose crc32(key) mod 3 is not 1.

    Rows that agree in key and text count once; at most about twice ``sample`` rows are returned, however many texts a key has.
    """
    open_ = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (F.crc32(F.col(key).cast("string")) % 3 != 1))
    known = open_.groupBy(F.col(key).alias("__id")).agg(F.max(label).alias("label"))
    known = stage(known, "labels")
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    # About ``sample`` rows of an id and a label: a bounded broadcast.
    slim = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    joined = slim.join(F.broadcast(chosen), F.col("__key") == F.col("__id"))
    rows = stage(joined.select("__id", "text", F.col("label").cast("int").alias("label")).distinct(), "training-rows")
    found = rows.count()
    if found > 2 * sample:
        # Ids with many texts: their rows are thinned out by hash in turn.
        rows = rows.where(F.pmod(F.xxhash64("__id", "text", F.lit(13)), F.lit(1_000_000)) < int(sample / found * 1_000_000))
    return rows.select("text", "label")


def feature_counts(rows: DataFrame) -> DataFrame:
    """Per feature the toxic and other rows that have it, added up in each task first."""
    def count(batches):

        distinct, features = word_features()
        counts: dict = {}
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                for f in {f for w in distinct(text) for f in features(w)}:
                    pair = counts.setdefault(f, [0, 0])
                    pair[1 if label else 0] += 1
            if len(counts) > 300_000:
                yield pd.DataFrame([(f, n, t) for f, (n, t) in counts.items()], columns=["feature", "other", "toxic"])
                counts = {}
        yield pd.DataFrame([(f, n, t) for f, (n, t) in counts.items()], columns=["feature", "other", "toxic"])

    parts = rows.mapInPandas(count, "feature string, other long, toxic long")
    return parts.groupBy("feature").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))


def telling_features(counts: DataFrame, other: int, toxic: int, most: int) -> list[str]:
    """The features that speak most for toxicity, by log odds in standard errors. Those that speak against it are only
    frequent elsewhere; they would let a long text outvote what it says."""
    t, n = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(t / (F.lit(toxic + 1.0) - t)) - F.log(n / (F.lit(other + 1.0) - n))
    scored = counts.where(F.col("toxic") + F.col("other") >= LEAST_ROWS).withColumn("z", odds / F.sqrt(1 / t + 1 / n))
    return [r["feature"] for r in scored.where("z >= 2.5").orderBy(F.desc("z"), "feature").limit(most).select("feature").collect()]


def sparse_rows(rows: DataFrame, names: list[str]) -> list:
    """Per sampled row its label, its features' numbers, and the changes that swaps of identity terms in its sentences make."""
    number = {f: i for i, f in enumerate(names)}
    kinds = IDENTITY_TERMS

    def look_up(batches):
        import re

        distinct, features = word_features()
        group = {term: kind for kind in kinds for term in kind}
        ends = re.compile(r"[.!?\n]+")
        cache: dict = {}

        def ids(words):
            out = set()
            for w in words:
                if w not in cache:
                    cache[w] = [number[f] for f in features(w) if f in number]
                out.update(cache[w])
            return out

        for pdf in batches:
            out = []
            for text, label in zip(pdf["text"], pdf["label"]):
                words = distinct(text)
                swaps = []
                if not words.isdisjoint(group):
                    for sentence in ends.split(text):
                        said = distinct(sentence)
                        for term in sorted(said & group.keys()):
                            kind = group[term]
                            before = ids(said)
                            other = kind[(kind.index(term) + 1) % len(kind)]
                            after = ids(said - {term} | {other})
                            swaps.append(sorted(after - before) + [-1 - f for f in sorted(before - after)])
                out.append((label, sorted(ids(words)), swaps))
            yield pd.DataFrame(out, columns=["label", "ids", "swaps"])

    return rows.mapInPandas(look_up, "label int, ids array<int>, swaps array<array<int>>").collect()


def fit(rows: DataFrame, features: int = FEATURES, penalty: float = PENALTY, shrink: float = SHRINK, rounds: int = 800) -> Model:
    """Fit on rows of text and label. With one class only, the score is that class's share, smoothed."""
    import numpy as np

    sums = {r["label"]: r["n"] for r in rows.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count("*").alias("n")).collect()}
    other, toxic = sums.get(0, 0), sums.get(1, 0)
    prior = float(np.log((toxic + 1) / (other + 1)))
    if not other or not toxic:
        return Model(min(prior, 0.0), {})
    names = telling_features(feature_counts(rows), other, toxic, features)
    terms = [t for kind in IDENTITY_TERMS for t in kind]
    names = list(dict.fromkeys([*names, *terms]))
    data = sorted(sparse_rows(rows, names), key=lambda r: (r["label"], r["ids"]))
    y = np.array([1.0 if r["label"] else 0.0 for r in data])
    row = np.repeat(np.arange(len(data)), [len(r["ids"]) for r in data])
    col = np.array([i for r in data for i in r["ids"]], dtype=np.int64)
    swaps = [s for r in data for s in r["swaps"] if s]
    s_row = np.repeat(np.arange(len(swaps)), [len(s) for s in swaps]).astype(np.int64)
    s_col = np.array([f if f >= 0 else -1 - f for s in swaps for f in s], dtype=np.int64)
    s_sign = np.array([1.0 if f >= 0 else -1.0 for s in swaps for f in s])
    # Either class weighs half, so that a single telling word can outweigh the rarity of toxic rows.
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, b = np.zeros(len(names)), 0.0
    # Adam over all sampled rows at once: deterministic.
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(row, w[col], len(data)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        grad = np.bincount(col, error[row], len(names)) + 2 * shrink * w
        if swaps:
            change = np.bincount(s_row, s_sign * w[s_col], len(swaps))
            grad += 2 * penalty * np.bincount(s_col, s_sign * change[s_row], len(names)) / len(swaps)
        g = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w -= move[:-1]
        b -= move[-1]
    return Model(float(b), {f: float(x) for f, x in zip(names, w) if x})


def score_of(model: Model):
    """A column function from text to score; null and empty texts get the model's bias."""
    bias, weights = model.bias, model.weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        distinct, features = word_features()
        number = {f: i for i, f in enumerate(weights)}
        value = list(weights.values())
        cache: dict = {}
        for texts in batches:
            z = []
            for text in texts:
                ids = set()
                for w in distinct(text) if text else ():
                    hit = cache.get(w)
                    if hit is None:
                        hit = cache[w] = tuple(number[f] for f in features(w) if f in number)
                    if hit:
                        ids.update(hit)
                z.append(bias + sum(value[i] for i in sorted(ids)))
            if len(cache) > 500_000:
                cache.clear()
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -30, 30))))

    return score


def learned_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                  sample: int = SAMPLE) -> Model:
    """The model of a table and its labels. Labels without a document, null labels and null ids are not used; a row with
    several labels takes the greatest."""
    short_batches(docs.sparkSession)
    return fit(training_rows(docs, labels, key, text, label, sample))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                   sample: int = SAMPLE) -> DataFrame:
    """One row per document: key, whether its label was held out, its score and the decision at ``TOXIC_FROM``.

    Null and empty texts are scored like others, by the bias alone; a null key is held in; repeated rows stay; an empty table
    gives none. Other columns are not read.
    """
    score = score_of(learned_model(docs, labels, key, text, label, sample))
    rows = docs.select(F.col(key).alias("doc_id"), score(F.col(text)).alias("score"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    score = score_of(learned_model(docs, labels, key, text, label))
    return docs.where(score(F.col(text)) < TOXIC_FROM)
