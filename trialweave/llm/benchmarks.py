"""Benchmark decontamination by SimHash of item-sized windows.

Only DataFrame functions. A window as similar to an item as is asked shares a known number of shingles with it, so the windows worth a
fingerprint are those that hold so many shingles of items of their length, in any order. Each window is as long as its item and gets a 64-bit SimHash. The 64
bits are cut into one block more than the radius: fingerprints within the radius agree in at least one block, so an
equality join on (window length, block, value) finds all of them. Candidates are verified by their weighted shingles: the
sum of the smaller counts over the sum of the larger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.session import stage

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 20
# Distinct item shingles (a hash each) up to which the shingle index is broadcast; beyond, both sides are shuffled.
BROADCAST_SHINGLES = 2_000_000


def word_list(text: Column) -> Column:
    """Lower-cased words: stretches of letters and digits of any script."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: str, width: int) -> Column:
    """Hashes of ``width`` words each, one per start; a shorter list is one shingle of all its words."""
    h = F.col(hashes)
    count = F.size(h) - width + 1
    starts = F.sequence(F.lit(1), F.greatest(count, F.lit(1)))
    return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, width))))


def items_with_shingles(items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``item_id``, its length ``size`` in words, the hash ``item`` of its words and its shingles; items without words are left out."""
    words = items.where(F.col(key).isNotNull()).select(F.col(key).alias("item_id"), word_hashes(word_list(F.col(text))).alias("h"))
    return words.where(F.size("h") > 0).select(
        "item_id", F.size("h").alias("size"), F.xxhash64("h").alias("item"), shingles("h", width).alias("shingles")).distinct()


def fingerprint_of(rows: DataFrame, keys: list[str], shingle: str) -> DataFrame:
    """SimHash per group of rows of one shingle each: a bit is set if more than half the hashes have it."""
    sums = [F.sum(F.shiftrightunsigned(F.col(shingle), i).bitwiseAND(1)).alias(f"b{i}") for i in range(64)]
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    value = F.lit(0).cast("long")
    for i in range(64):
        value = value.bitwiseOR(F.when(F.col(f"b{i}") * 2 > F.col("n"), F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, value.alias("fp"))


def block_rows(df: DataFrame, radius: int) -> DataFrame:
    """One row per block of ``fp``: ``block`` and its ``value``."""
    blocks = radius + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    values = [F.shiftrightunsigned(F.col("fp"), cuts[i]).bitwiseAND((1 << (cuts[i + 1] - cuts[i])) - 1) for i in range(blocks)]
    return df.select("*", F.posexplode(F.array(*values)).alias("block", "value"))


def weighted(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "shingle").agg(F.count("*").alias("w"))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
          width: int = WIDTH, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Pairs of a document and an item it contains, with the similarity and the first word of the best window.

    Windows are compared over the whole text and counted in words without punctuation. Items of fewer words than a shingle are
    compared as one sequence. Texts or items that are null or without words match nothing, as do null keys. Repeated
    rows are one document; texts that share a key are compared one by one, and the best of them counts, as with items; an empty table gives none; other columns are not read. The join to the items' shingles
    starts from the texts in place; after it only rows of shared shingles move.
    """
    spark = docs.sparkSession
    own = ["doc_id", "words", "length"]
    keys = [*own, "size", "first"]
    wanted = stage(items_with_shingles(items, item_key, item_text, width), "items")
    index = wanted.select("size", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.collect_set("size").alias("sizes"))
    index = stage(index, "item-shingles")
    known = index.count()
    if not known:
        kind = dict(docs.dtypes)[key]
        return spark.createDataFrame([], f"doc_id {kind}, item_id {dict(items.dtypes)[item_key]}, similarity double, first_word long")
    short = [r["size"] for r in wanted.where(F.col("size") < width).select("size").distinct().collect()]

    hashed = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), word_hashes(word_list(F.col(text))).alias("h")).where(F.size("h") > 0)
    hashed = hashed.select("doc_id", F.xxhash64("h").alias("words"), F.size("h").alias("length"), "h")
    spread = hashed.select(*own, F.posexplode(shingles("h", width)).alias("pos", "shingle"))
    for size in short:
        # The only shingle of a short item has the item's own length.
        few = hashed.where(F.col("length") >= size).select(*own, F.posexplode(shingles("h", size)).alias("pos", "shingle"))
        spread = spread.unionByName(few)
    hits = spread.join(F.broadcast(index) if known <= BROADCAST_SHINGLES else index, "shingle")
    places = hits.select(*own, "pos", F.explode("sizes").alias("size")).groupBy(*own, "size").agg(
        F.sort_array(F.collect_set("pos")).alias("at"))
    # A similar window holds this many shingles of its item, whatever their order; it starts within reach of the first and the last of them.
    counts = F.greatest(F.least("size", "length") - width + 1, F.lit(1)) + F.greatest(F.col("size") - width + 1, F.lit(1))
    places = places.withColumn("need", F.ceil(counts * (similarity / (1 + similarity)) - 1e-9).cast("int")).where("size(at) >= need")
    reach = f"greatest(0, at[i + need - 1] - greatest(size - {width}, 0))", "least(at[i], greatest(length - size, 0))"
    first = F.expr(f"array_distinct(flatten(transform(sequence(0, size(at) - need), i -> if({reach[0]} <= {reach[1]}, sequence({reach[0]}, {reach[1]}), array()))))")
    windows = stage(places.select(*own, "size", F.explode(first).alias("first")), "windows")
    texts = stage(hashed.join(windows.select("doc_id").distinct(), "doc_id", "left_semi").distinct(), "hit-texts")
    cut = windows.join(texts, own).select(*keys, F.slice("h", F.col("first") + 1, F.col("size")).alias("h"))
    window_rows = stage(cut.select(*keys, F.explode(shingles("h", width)).alias("shingle")), "window-shingles")
    item_rows = wanted.select("item_id", "item", "size", F.explode("shingles").alias("shingle"))
    w = block_rows(fingerprint_of(window_rows, keys, "shingle"), radius)
    i = block_rows(fingerprint_of(item_rows, ["item_id", "item", "size"], "shingle"), radius).select(
        "item_id", "item", F.col("size").alias("i_size"), F.col("fp").alias("i_fp"), F.col("block").alias("i_block"), F.col("value").alias("i_value"))
    within = F.bit_count(F.col("fp").bitwiseXOR(F.col("i_fp"))) <= radius
    same = (F.col("size") == F.col("i_size")) & (F.col("block") == F.col("i_block")) & (F.col("value") == F.col("i_value"))
    candidates = stage(w.join(i, same & within).select(*keys, "item_id", "item").distinct(), "leak-candidates")
    # A text shorter than the item has fewer shingles than it; all count for the union.
    a = weighted(window_rows, keys)
    b = weighted(item_rows.drop("size"), ["item_id", "item"]).select("item_id", "item", F.col("shingle").alias("i_shingle"), F.col("w").alias("i_w"))
    both = candidates.join(a, keys).join(b, ["item_id", "item"]).where(F.col("shingle") == F.col("i_shingle"))
    common = both.groupBy(*keys, "item_id", "item").agg(F.sum(F.least("w", "i_w")).alias("c"))
    total = counts - F.col("c")
    found = common.withColumn("similarity", F.col("c") / total).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("first")).alias("f"))).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("m.similarity").alias("similarity"), (-F.col("m.f")).cast("long").alias("first_word"))


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item; rows with a null key stay."""
    found = stage(leaks(docs, items, key, text).select(F.col("doc_id").alias("__id")).distinct(), "leaks")
    return docs.join(found, docs[key] == found["__id"], "left_anti")
