"""Repeated passages by recompression.

Tokens are compressed in rounds, alike everywhere. First every run of one word gets a name, then round by round each
pair of neighbours (a, b) with a in the left and b in the right half of the names gets one; which half a name is in
changes from round to round and depends on the name only. So two equal passages are compressed alike inside: per round
at most one symbol at either end can depend on what stands outside. Taking those off (first and last run, a leading
right-half name, a trailing left-half name) leaves the symbols that every occurrence of a passage shares.

Each window is filed under a shared symbol of the last round in which it has any, so equal windows meet under equal symbols;
the windows filed there are then compared by a 64-bit hash of their words. Names are 64-bit hashes of what they stand for: that makes them global
without an exchange per round, and a clash of names costs a needless comparison but can lose no repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import short_batches
from trialweave.session import stage

WINDOW = 35
ROUNDS = 8
# Characters of text whose windows one reducing task group compares.
BUCKET_CHARS = 12_000_000
# Characters compressed at a time within a task.
PART_CHARS = 1_500_000
HASH_BYTES = 8
# A symbol with more windows than this is hot: its windows are dealt by their hashes too. One row in HOT_SAMPLE is looked at to find such symbols.
HOT_WINDOWS = 100_000
HOT_SAMPLE = 64


def recompressor(window: int):
    """A function from lists of words to (symbol, window hash) of every window, laid out over all words of the lists."""
    from itertools import chain

    import numpy as np
    from xxhash import xxh64_intdigest

    u = np.uint64
    odd, inverse = u(0x9E3779B97F4A7C15), u(pow(0x9E3779B97F4A7C15, -1, 2**64))

    def mix(x):
        x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
        return x ^ (x >> u(31))

    def windows(lists):
        """Start of each window in the concatenation, the list it is from, its symbol and its hash."""
        sizes = np.array([len(w) for w in lists], np.int64)
        total = int(sizes.sum())
        owner = np.repeat(np.arange(len(lists)), sizes)
        word = np.fromiter(map(xxh64_intdigest, chain.from_iterable(lists)), np.uint64, total)
        starts = np.arange(total - window + 1, dtype=np.int64) if total >= window else np.empty(0, np.int64)
        starts = starts[owner[starts] == owner[starts + window - 1]]
        if not len(starts):
            return starts, starts, np.empty(0, np.uint64), np.empty(0, np.uint64)
        powers = np.cumprod(np.full(total, odd))
        back = np.cumprod(np.full(total, inverse))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * powers)])
        own = mix((sums[starts + window] - sums[starts]) * back[starts])
        # Runs of one word.
        first = np.ones(total, bool)
        first[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(first)
        name = mix(word[at] + u(3) * np.diff(np.append(at, total)).astype(np.uint64))
        group = owner[at]
        parent = np.cumsum(first) - 1
        low, high = parent[starts] + 1, parent[starts + window - 1] - 1
        symbol = own.copy()
        open_ = np.flatnonzero(low <= high)
        low, high = low[open_], high[open_]
        for step in range(1, ROUNDS + 1):
            if not len(open_):
                break
            left = (mix(name + u(int(odd) * step & 2**64 - 1)) >> u(63)).astype(bool)
            fused = np.zeros(len(name), bool)
            fused[:-1] = left[:-1] & ~left[1:] & (group[:-1] == group[1:])
            new_low, new_high = low + ~left[low], high - left[high]
            done = (new_low > new_high) | (step == ROUNDS)
            if done.any():
                # The least name of the symbols that are left stands for the window.
                lo, hi = low[done], high[done]
                least = name[lo]
                for k in range(1, int((hi - lo).max()) + 1):
                    more = lo + k <= hi
                    least[more] = np.minimum(least[more], name[lo[more] + k])
                symbol[open_[done]] = mix(least + u(step))
            starting = np.ones(len(name), bool)
            starting[1:] = ~fused[:-1]
            up = np.cumsum(starting) - 1
            at = np.flatnonzero(starting)
            pair = fused[at]
            grown = name[at].copy()
            grown[pair] = mix(name[at[pair]] * u(5) + mix(name[at[pair] + 1] + u(7)))
            rest = ~done
            low, high, open_ = up[new_low[rest]], up[new_high[rest]], open_[rest]
            name, group = grown, group[at]
        return starts, owner[starts], symbol, own

    return windows


def hot_symbols(rows: DataFrame, window: int) -> list[int]:
    """Symbols with more than ``HOT_WINDOWS`` windows, as a sample of the rows shows them; so few that they may pass the driver.

    The choice only deals windows to tasks. It is the same for all tasks, and a wrong one changes no result.
    """
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "crc"), F.lit(HOT_SAMPLE)) == 0)
    counts = filed_windows(sample, window).where("n > 0").groupBy("symbol").agg(F.sum("n").alias("n"))
    return [r["symbol"] for r in counts.where(F.col("n") * HOT_SAMPLE > HOT_WINDOWS).select("symbol").collect()]


def filed_windows(rows: DataFrame, window: int, hot: list[int] | None = None) -> DataFrame:
    """Stretches of consecutive windows filed under one symbol: symbol, row, first word, hashes; and, with an empty hash list
    and a length below zero, stretches of words known to repeat within the rows a task has in hand.

    A window that occurs more than once there is filed only once, so a hot passage comes once per batch. A window of a ``hot``
    symbol is filed alone, under a symbol made of that and its hash, so that the windows of one hot symbol spread.
    """
    spread = sorted(hot or [])
    short_batches(rows.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        windows = recompressor(window)
        wide = np.array(spread, np.int64).view(np.uint64)

        def filed(ids, crcs, lists):
            starts, owner, symbol, own = windows(lists)
            if not len(starts):
                return None
            if len(wide):
                many = np.isin(symbol, wide)
                symbol[many] = (symbol[many] ^ own[many]) * np.uint64(0x9E3779B97F4A7C15)
            base = np.cumsum([0, *[len(w) for w in lists]])[:-1]
            order = np.lexsort((own, symbol))
            same = (symbol[order][1:] == symbol[order][:-1]) & (own[order][1:] == own[order][:-1])
            again, twice = np.zeros(len(order), bool), np.zeros(len(order), bool)
            again[order[1:]] = same
            twice[order[1:]] |= same
            twice[order[:-1]] |= same
            keep = np.flatnonzero(~again)
            s, o, p = symbol[keep], owner[keep], starts[keep]
            cut = np.ones(len(keep), bool)
            cut[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1) | (o[1:] != o[:-1])
            at = np.flatnonzero(cut)
            length = np.diff(np.append(at, len(keep)))
            data = own[keep].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
            offsets = np.append(at, len(keep)).astype(np.int32) * HASH_BYTES
            # What is known already.
            known = np.flatnonzero(twice)
            kp, ko = starts[known], owner[known]
            kcut = np.ones(len(known), bool)
            kcut[1:] = (kp[1:] != kp[:-1] + 1) | (ko[1:] != ko[:-1])
            kat = np.flatnonzero(kcut)
            klen = np.diff(np.append(kat, len(known))) + window - 1
            rows_ = np.concatenate([o[at], ko[kat]])
            first = np.concatenate([p[at] - base[o[at]], kp[kat] - base[ko[kat]]])
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([s[at], symbol[known[kat]]]).view(np.int64)),
                ids.take(pa.array(rows_)), crcs.take(pa.array(rows_)), pa.array(first.astype(np.int32)),
                pa.array(np.concatenate([length, -klen]).astype(np.int32)),
                pa.Array.from_buffers(pa.binary(), len(rows_), [None, pa.py_buffer(np.concatenate(
                    [offsets, np.full(len(kat), offsets[-1], np.int32)]).tobytes()), pa.py_buffer(data)]),
            ], names=["symbol", "doc_id", "crc", "first", "n", "hashes"])

        for batch in batches:
            texts = batch.column(2).to_pylist()
            start, chars = 0, 0
            for i, t in enumerate(texts):
                chars += len(t or "")
                if chars >= PART_CHARS or i == len(texts) - 1:
                    part = slice(start, i + 1)
                    out = filed(batch.column(0)[part], batch.column(1)[part], [(x or "").encode("utf-8").split() for x in texts[part]])
                    if out is not None:
                        yield out
                    start, chars = i + 1, 0

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "crc", "text").mapInArrow(run, f"symbol long, doc_id {kind}, crc long, first int, n int, hashes binary")


def repeated_stretches(filed: DataFrame, window: int, buckets: int) -> DataFrame:
    """Stretches of words (row, first, n) covered by windows that occur more than once. Buckets are cut by symbol."""
    kind = dict(filed.dtypes)["doc_id"]

    def compare(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        n = table.column("n").to_numpy()
        known = np.flatnonzero(n < 0)
        filed_ = np.flatnonzero(n > 0)
        rows, first, length = [known], [table.column("first").to_numpy()[known]], [-n[known]]
        if len(filed_):
            count = n[filed_].astype(np.int64)
            raw = np.frombuffer(b"".join(table.column("hashes").take(pa.array(filed_)).to_pylist()), np.uint8).reshape(-1, HASH_BYTES)
            own = np.zeros((len(raw), 8), np.uint8)
            own[:, :HASH_BYTES] = raw
            own = own.view(np.uint64).ravel()
            symbol = np.repeat(table.column("symbol").to_numpy()[filed_].view(np.uint64), count)
            order = np.argsort(symbol * np.uint64(0x9E3779B97F4A7C15) + own * np.uint64(0xC2B2AE3D27D4EB4F), kind="stable")
            same = (symbol[order][1:] == symbol[order][:-1]) & (own[order][1:] == own[order][:-1])
            hit = np.zeros(len(own), bool)
            hit[order[1:]] |= same
            hit[order[:-1]] |= same
            source = np.repeat(filed_, count)
            place = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            at = np.flatnonzero(hit)
            if len(at):
                cut = np.ones(len(at), bool)
                cut[1:] = (at[1:] != at[:-1] + 1) | (source[at][1:] != source[at][:-1])
                begin = np.flatnonzero(cut)
                rows.append(source[at[begin]])
                first.append(table.column("first").to_numpy()[source[at[begin]]] + place[at[begin]])
                length.append(np.diff(np.append(begin, len(at))) + window - 1)
        rows = pa.array(np.concatenate(rows).astype(np.int64))
        return pa.table({"doc_id": table.column("doc_id").take(rows), "crc": table.column("crc").take(rows),
                         "first": pa.array(np.concatenate(first).astype(np.int32)), "n": pa.array(np.concatenate(length).astype(np.int32))})

    # Stretches known already are compared with none, so they go anywhere.
    dealt = F.when(F.col("n") < 0, F.xxhash64("doc_id", "crc", "first")).otherwise(F.xxhash64("symbol"))
    bucketed = filed.withColumn("bucket", F.pmod(dealt, F.lit(buckets)))
    return bucketed.groupBy("bucket").applyInArrow(compare, f"doc_id {kind}, crc long, first int, n int")


def _without_stretches(batches):
    import hashlib

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        n_words, n_removed, digests = [], [], []
        for text, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist()):
            words = (text or "").encode("utf-8").split()
            kept = words
            if stretches:
                edge = np.zeros(len(words) + 1, np.int64)
                for s in stretches:
                    edge[s["first"]] += 1
                    edge[s["first"] + s["n"]] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                kept = [words[i] for i in np.flatnonzero(~covered)]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests)],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, its words, the words removed, and the SHA-256 of the kept words joined by blanks.

    Removed is every word of a window of ``window`` words that occurs at another place, of the same document or another; windows
    are judged on the input. Null and empty texts have no words; texts shorter than a window keep all; repeated rows
    repeat each other; a null key is a key like any other; an empty table gives none; other columns are not read.
    """
    spark = docs.sparkSession
    # 64 bits tell the texts of one key apart, null keys included.
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("crc"), F.col(text).alias("text"))
    chars = docs.agg(F.sum(F.length(F.col(text)))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // BUCKET_CHARS))
    found = repeated_stretches(filed_windows(rows, window, hot_symbols(rows, window)), window, buckets)
    cover = stage(found.groupBy("doc_id", "crc").agg(F.collect_list(F.struct("first", "n")).alias("stretches")), "stretches")
    c = cover.select(F.col("doc_id").alias("c_id"), F.col("crc").alias("c_crc"), "stretches")
    joined = rows.join(c, rows["doc_id"].eqNullSafe(c["c_id"]) & (rows["crc"] == c["c_crc"]), "left").select("doc_id", "text", "stretches")
    kind = dict(rows.dtypes)["doc_id"]
    return joined.mapInArrow(_without_stretches, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
