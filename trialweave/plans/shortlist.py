"""Shortlist: score chunks of studies against a question, keep the best.

The scorer is the caller's: a function for ``mapInPandas`` that takes (chunk, context)
and returns (chunk, answer), the answer being free text with a fenced JSON list. A chunk
is one row, so the chunks are scored in parallel.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trialweave.functions import text
from trialweave.functions.answers import FENCE, scored_rows
from trialweave.operators import ordering
from trialweave.operators.filters import above
from trialweave.operators.ordering import chunk_context, chunk_rows
from trialweave.session import stage

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
ANSWER_SCHEMA = "chunk long, answer string"


def keyword_scorer(words: Sequence[str]) -> Scorer:
    """Deterministic stand-in for a remote scorer: share of the words found in a line."""
    wanted = [w.lower() for w in words]
    line = re.compile(r"^- id: (\d+), (.*)$", re.MULTILINE)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = []
            for context in batch["context"]:
                rows = []
                for number, rest in line.findall(context):
                    shown = rest.lower()
                    share = sum(w in shown for w in wanted) / len(wanted)
                    rows.append({"database_index": int(number), "certainty": share})
                answers.append(f"Result:\n{FENCE}json\n{json.dumps(rows)}\n{FENCE}\n")
            yield pd.DataFrame({"chunk": batch["chunk"], "answer": answers})

    return score


# Tasks that ask a scorer whose answers are stored; below as many chunks each one has its own.
ASKING_TASKS = 10_000
STORE_SCHEMA = "digest string, answer string"


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """The answers of a store, one per context digest; empty where there is none yet."""
    try:
        rows = spark.read.schema(STORE_SCHEMA).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], STORE_SCHEMA)
    return rows.groupBy("digest").agg(F.min("answer").alias("answer"))


def asked_once(contexts: DataFrame, scorer: Scorer, store: str) -> DataFrame:
    """(chunk, answer), asking the scorer only for contexts the store has no answer to.

    The store is a folder of Parquet files to which answers are only added, by the SHA-256 of the context they belong to. Each task
    adds its answers as it ends, whatever becomes of the others, so a second run after a failure asks for what is missing, and a task
    that is tried again for its own chunks. Equal contexts are asked about once. Runs when called.
    """
    spark = contexts.sparkSession
    known = stage(contexts.select("chunk", "context", F.sha2("context", 256).alias("digest")), "contexts")
    firsts = known.groupBy("digest").agg(F.min("chunk").alias("chunk"))
    missing = stage(firsts.join(stored_answers(spark, store).select("digest"), "digest", "left_anti"), "unanswered")
    open_chunks = missing.count()

    def with_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digests: dict[int, str] = {}

        def passed() -> Iterator[pd.DataFrame]:
            for batch in batches:
                digests.update(zip(batch["chunk"], batch["digest"]))
                yield batch[["chunk", "context"]]

        for answers in scorer(passed()):
            yield pd.DataFrame({"digest": [digests[c] for c in answers["chunk"]], "answer": answers["answer"]})

    if open_chunks:
        spread = known.join(missing, ["chunk", "digest"], "left_semi").repartition(min(open_chunks, ASKING_TASKS), "digest")
        # Version 2 of the commit protocol makes a task's file visible when the task ends, not when the job does.
        spread.mapInPandas(with_digests, STORE_SCHEMA).write.mode("append").option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(store)
    return known.join(stored_answers(spark, store), "digest").select("chunk", "answer")


def ask(contexts: DataFrame, scorer: Scorer, store: str | None = None) -> DataFrame:
    """Answers of the scorer as rows; a chunk without rows gives one without index, ``bad`` if its answer is unreadable.

    With a ``store`` no context is asked about twice, in this run or a later one.
    """
    found = asked_once(contexts, scorer, store) if store else contexts.select("chunk", "context").mapInPandas(scorer, ANSWER_SCHEMA)
    rows = found.select("chunk", scored_rows(F.col("answer")).alias("rows"))
    return rows.select("chunk", F.col("rows").isNull().alias("bad"), F.inline_outer("rows"))


def bad_answers(asked: DataFrame) -> DataFrame:
    """Number of chunks whose answer was unreadable, from the rows of :func:`ask`; the scorer is not asked again."""
    return asked.agg(F.count_if("bad").alias("bad_answers"))


def watched(asked: DataFrame, watch: Observation | None) -> DataFrame:
    """Counts unreadable answers as ``bad_answers`` of ``watch`` while the rows pass."""
    return asked.observe(watch, F.count_if("bad").alias("bad_answers")) if watch else asked


def first_choice(studies: DataFrame, key: str, title: str, date: str | None, scorer: Scorer, size: int = 100,
                 proportion: float = 1.0, kind: str = "recent", seed: int = 123, watch: Observation | None = None,
                 store: str | None = None) -> DataFrame:
    """(database_index, certainty, chunk) from one scorer call per chunk of titles.

    Chunks follow the dates, latest first, or a seeded shuffle. All are asked about; a
    ``proportion`` below 1, such as 0.5, asks about the first share of them only.
    """
    chunks = _chunked(studies, key, date, kind, seed, size, proportion)
    contexts = _contexts(chunks, studies, key, [("Title", F.col(title))],
                         "List of clinical trials to be filtered by context:")
    found = watched(ask(contexts, scorer, store), watch).where("database_index IS NOT NULL")
    return found.select("database_index", "certainty", "chunk")


def final_context(chosen: DataFrame, studies: DataFrame, key: str, date: str | None,
                  fields: Sequence[tuple[str, Column]], kind: str = "recent", seed: int = 123,
                  size: int = 100) -> DataFrame:
    """Detailed blocks of the chosen studies, of at most ``size`` lines each.

    ``chosen`` holds the key, and the date where there is one, of each study once.
    """
    chunks = _chunked(chosen, key, date, kind, seed, size)
    return _contexts(chunks, studies, key, fields, "Short list of clinical trials:")


def shortlist(studies: DataFrame, key: str, title: str, date: str | None, fields: Sequence[tuple[str, Column]],
              scorer: Scorer, final_scorer: Scorer | None = None, size: int = 100, proportion: float = 1.0,
              cutoff: float = 0.5, kind: str = "recent", seed: int = 123, best: int = 5,
              watch: Observation | None = None, store: str | None = None) -> DataFrame:
    """The ``best`` studies for a question as (database_index, certainty, Title).

    The chosen studies go to the final scorer in blocks as well, so their number has no
    bound; its best answers over all blocks are the result. ``key`` is unique. With a ``store`` (see :func:`asked_once`) neither scorer is
    asked again what it has answered.
    """
    scored = first_choice(studies, key, title, date, scorer, size, proportion, kind, seed, watch, store)
    picked = scored.where(above(F.col("certainty"), cutoff)).select(F.col("database_index").alias(key))
    chosen = studies.select(*_order_columns(key, date)).join(picked, key, "left_semi")
    contexts = final_context(chosen, studies, key, date, fields, kind, seed, size)
    answers = ask(contexts, final_scorer or scorer, f"{store}-final" if store and final_scorer else store).where("database_index IS NOT NULL")
    top = answers.orderBy(F.desc_nulls_last("certainty"), "database_index").limit(best)
    # At most ``best`` rows: the studies are cut down to them where they lie, before their titles are made.
    top = stage(top, "best")
    wanted = F.broadcast(top.select(F.col("database_index").alias("__wanted")))
    few = studies.join(wanted, studies[key] == F.col("__wanted"), "left_semi")
    titles = few.select(F.col(key).alias("__key"), F.col(title).alias("__title"))
    return (
        top.join(titles, top["database_index"] == titles["__key"], "left")
        .select("database_index", "certainty", F.coalesce("Title", "__title").alias("Title"))
    )


def _order_columns(key: str, date: str | None) -> list[str]:
    return [key, date] if date else [key]


def _chunked(rows: DataFrame, key: str, date: str | None, kind: str, seed: int, size: int,
             proportion: float = 1.0) -> DataFrame:
    """Chunk and ordinal per key. Only keys and dates are sorted, never the texts."""
    return chunk_rows(rows.select(*_order_columns(key, date)), _order(key, date, kind, seed), size, proportion)


def _contexts(chunks: DataFrame, studies: DataFrame, key: str, fields: Sequence[tuple[str, Column]],
              header: str) -> DataFrame:
    lines = studies.select(key, text.labelled_line([("id", F.col(key)), *fields]).alias("__line"))
    return chunk_context(chunks.select(key, "chunk", "ordinal").join(lines, key), F.col("__line"), header)


def _order(key: str, date: str | None, kind: str, seed: int) -> list[Column]:
    if kind == "recent":
        return [F.desc_nulls_last(date), F.col(key)]
    if kind == "sample":
        return ordering.sample_order(key, seed)
    return [F.col(key)]
