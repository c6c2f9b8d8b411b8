"""Conversation structure repair: the cheapest edits that give a conversation legal roles.

Legal roles, by initial, are none at all or ``s?(ua)+``: an optional system turn, then pairs of user and assistant. Edits
and their costs: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for blank and repeated rows), Insert an empty
user or assistant turn 2; a truncated row that stays adds 1. Among the cheapest sequences of edits the one whose initials come
first in ASCII is taken.

The states between rows are: nothing yet, after system, after user, after assistant. A conversation of n rows is cut into
blocks of about sqrt(n) rows. Each block becomes a matrix of least costs from state to state; one backward pass over the at
most sqrt(n) matrices of a conversation leaves the vector of remaining costs at every checkpoint, the border of two blocks.
Only these are stored. Each block then recomputes its inner vectors from its checkpoint and walks forward along tight edits,
for every state it can be entered in; a forward pass over the checkpoints picks the state that is. Blocks run apart from each
other, so a conversation that holds a third of all rows is spread over many tasks and no task sees more than about sqrt(n)
rows or matrices of one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.operators.ordering import with_ordinals
from trialweave.session import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"
# Shorter conversations are one block.
SMALLEST_BLOCK = 64
# One letter a row: four kinds of fault by four kinds of initial.
CODES = "ABCDEFGHIJKLMNOP"
FAULTS, INITIALS = ("none", "blank", "duplicate", "truncated"), ("s", "u", "a")
NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
# The state after an inserted or reroled row, and after a kept one by its initial (none: it can't be kept there).
OFFERED = (USER, USER, ASSISTANT, USER)
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
LETTER = {USER: "u", ASSISTANT: "a"}


def with_inserts(costs):
    """Let empty turns be inserted before a position: at most three in a row can pay off."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[OFFERED[s]]) for s, c in enumerate(costs)]
    return costs


# Nothing left: an empty conversation or one that ends with an assistant is complete.
FINISHED = with_inserts([0, NEVER, NEVER, 0])


def before_row(code: str, after):
    """Remaining costs before a row, from those after it."""
    fault, initial = divmod(CODES.index(code), 4)
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if fault in (0, 3):
            extra = TRUNCATED if fault == 3 else 0
            best = min(best, REROLE + extra + after[OFFERED[state]])
            if KEPT[state][initial] is not None:
                best = min(best, KEEP + extra + after[KEPT[state][initial]])
        costs.append(min(best, NEVER))
    return with_inserts(costs)


def block_matrix(codes: str):
    """Least costs from the state before the block's first row (rows) to the state after its last (columns), flat."""
    columns = []
    for end in range(4):
        costs = [0 if s == end else NEVER for s in range(4)]
        for code in reversed(codes):
            costs = before_row(code, costs)
        columns.append([min(c, NEVER) for c in costs])
    return [columns[t][s] for s in range(4) for t in range(4)]


def backward(matrices):
    """Remaining costs after each block, and before the first."""
    vector, out = list(FINISHED), []
    for m in reversed(matrices):
        out.append(vector)
        vector = [min(min(int(m[4 * s + t]) + vector[t], NEVER) for t in range(4)) for s in range(4)]
    return out[::-1], vector


def walk(codes: str, vector, state: int, last: bool):
    """The block's edits along tight costs from a state: one text a row, and the state after the block.

    A text holds the edits up to its row's own: ``aIK`` inserts an assistant turn and keeps the row, ``uR`` makes it a user
    turn, ``D`` deletes it. After the last row of the last block one more text may follow, of inserts only.
    """
    after = [list(map(int, vector))]
    for code in reversed(codes):
        after.append(before_row(code, after[-1]))
    after.reverse()
    tokens = []
    for i, code in enumerate(codes):
        fault, initial = divmod(CODES.index(code), 4)
        extra, stays, text = (TRUNCATED if fault == 3 else 0), fault in (0, 3), ""
        while True:
            left, offered = after[i][state], OFFERED[state]
            if DELETE + after[i + 1][state] == left:
                text += "D"
            elif INSERT + after[i][offered] == left:
                text, state = text + LETTER[offered] + "I", offered
                continue
            elif stays and KEPT[state][initial] is not None and KEEP + extra + after[i + 1][KEPT[state][initial]] == left:
                text, state = text + "K", KEPT[state][initial]
            else:
                text, state = text + LETTER[offered] + "R", offered
            break
        tokens.append(text)
    tail = ""
    while last and state not in (START, ASSISTANT):
        state = OFFERED[state]
        tail += LETTER[state] + "I"
    return [*tokens, tail] if tail else tokens, state


def legal_pair(left: str, right: str) -> bool:
    a, b = CODES.index(left) % 4, CODES.index(right) % 4
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def block_summaries(codes):
    import pandas as pd

    known: dict = {}
    for c in codes:
        if c not in known:
            known[c] = (block_matrix(c), sum(not legal_pair(a, b) for a, b in zip(c, c[1:])), c[0] + c[-1])
    return pd.DataFrame([known[c] for c in codes], columns=["matrix", "illegal", "ends"])


def checkpoints(matrices, ends):
    import pandas as pd

    out = []
    for m, e in zip(matrices, ends):
        vectors, first = backward(m)
        out.append((vectors, first[START], sum(not legal_pair(a[1], b[0]) for a, b in zip(e, e[1:]))))
    return pd.DataFrame(out, columns=["vectors", "cost", "illegal"])


def block_walks(codes, vector, first, last):
    import pandas as pd

    known: dict = {}
    out = []
    for key in zip(codes, map(tuple, vector), first, last):
        if key not in known:
            walks = [walk(key[0], key[1], s, key[3]) if s == START or not key[2] else ([], START) for s in range(4)]
            known[key] = ([w[0] for w in walks], [w[1] for w in walks])
        out.append(known[key])
    return pd.DataFrame(out, columns=["tokens", "exits"])


def entry_states(exits):
    import pandas as pd

    out = []
    for blocks in exits:
        states, state = [], START
        for block in blocks:
            states.append(state)
            state = int(block[state])
        out.append(states)
    return pd.Series(out)


def coded_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows in order, staged: ``k`` (the conversation as text, null told apart), ``g`` (place over all rows), ``turn``,
    ``role``, ``text``. Rows of a conversation follow each other by turn (nulls first), role and text; a null role or text
    counts as one space."""
    plain = df.select(
        F.col(conv).alias("conv_id"), F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("null")).alias("k"),
        F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    order = [F.col("k"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")]
    numbered, _ = with_ordinals(plain, order, "g")
    return numbered.drop("tie")


def faulty_rows(rows: DataFrame) -> DataFrame:
    """``k, g, pos, n, turn, fault, code`` of every row: its place in its conversation, the first fault that it has, its code.

    The first of equal rows is found by aggregation with partial sums, so one row repeated without end is no hot group.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        kind = F.when(initial == letter, i).otherwise(kind)
    plain = rows.select("k", "g", "turn", kind.alias("kind"), (bare == "").alias("blank"),
                        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
                        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"))
    plain = stage(plain, "coded-rows")
    spans = plain.groupBy("k").agg(F.min("g").alias("start"), F.count("*").alias("n"))
    firsts = plain.groupBy("k", "digest").agg(F.min("g").alias("first"))
    known = plain.join(spans, "k").join(firsts, ["k", "digest"])
    fault = F.when(F.col("blank"), 1).when(F.col("g") > F.col("first"), 2).when(F.col("truncated"), 3).otherwise(0)
    coded = known.select("k", "g", (F.col("g") - F.col("start")).alias("pos"), "n", "turn", "kind", fault.alias("fault"))
    return coded.withColumn("code", F.substring(F.lit(CODES), F.col("fault") * 4 + F.col("kind") + 1, F.lit(1)))


def repaired_blocks(coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of every block (``k, block, g0, tokens``), and ``k, cost, illegal`` of every conversation."""
    length = F.greatest(F.lit(SMALLEST_BLOCK), F.ceil(F.sqrt("n")))
    codes = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    blocks = coded.withColumn("block", F.floor(F.col("pos") / length)).groupBy("k", "block").agg(F.min("g").alias("g0"), codes.alias("codes"))
    summary = F.pandas_udf(block_summaries, "struct<matrix:array<long>,illegal:long,ends:string>")
    blocks = stage(blocks.withColumn("s", summary("codes")).select("k", "block", "g0", "codes", "s.*"), "turn-blocks")

    listed = F.sort_array(F.collect_list(F.struct("block", "matrix", "ends", "illegal")))
    costs = F.pandas_udf(checkpoints, "struct<vectors:array<array<long>>,cost:long,illegal:long>")
    chains = blocks.groupBy("k").agg(listed.alias("c")).withColumn("p", costs("c.matrix", "c.ends"))
    within = F.aggregate("c.illegal", F.lit(0).cast("long"), lambda s, x: s + x)
    chains = stage(chains.select("k", "p.vectors", "p.cost", (F.col("p.illegal") + within).alias("illegal")), "checkpoints")
    vectors = chains.select("k", F.size("vectors").alias("blocks"), F.posexplode("vectors").alias("block", "vector"))
    walks = blocks.select("k", "block", "g0", "codes").join(vectors.withColumn("block", F.col("block").cast("long")), ["k", "block"])
    forward = F.pandas_udf(block_walks, "struct<tokens:array<array<string>>,exits:array<int>>")
    walks = walks.withColumn("w", forward("codes", "vector", F.col("block") == 0, F.col("block") == F.col("blocks") - 1))
    walks = stage(walks.select("k", "block", "g0", "w.*"), "block-walks")

    entered = walks.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("block", "exits"))).alias("c"))
    states = F.pandas_udf(entry_states, "array<int>")
    entered = entered.select("k", states("c.exits").alias("s")).select("k", F.posexplode("s").alias("block", "state"))
    entered = entered.withColumn("block", F.col("block").cast("long"))
    edits = walks.join(entered, ["k", "block"]).select("k", "block", "g0", F.col("tokens")[F.col("state")].alias("tokens"))
    return edits, chains.select("k", "cost", "illegal")


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``k, g, place, edit, role, text``: every edit in order (by ``g``, then ``place``), with the turn that it leaves.

    ``edit`` is K, R, D or I; a deleted row has neither role nor text. Inserts after the last row carry the next ``g``.
    """
    tokens = edits.select("k", F.col("g0"), F.posexplode("tokens").alias("i", "token")).select("k", (F.col("g0") + F.col("i")).alias("g"), "token")
    # Inserts at the very end share the place of the next conversation's first row, hence the second key.
    joined = tokens.join(rows.select("k", "g", "role", "text"), ["k", "g"], "left")
    single = joined.select("k", "g", "role", "text", F.posexplode(F.regexp_extract_all("token", F.lit("([ua]?[IRKD])"), 1)).alias("place", "step"))
    edit = F.right("step", F.lit(1))
    named = F.when(F.left("step", F.lit(1)) == "u", "user").otherwise("assistant")
    return single.select(
        "k", "g", "place", edit.alias("edit"), F.when(edit == "K", F.col("role")).when(edit != "D", named).alias("role"),
        F.when(edit.isin("K", "R"), F.col("text")).when(edit == "I", "").alias("text"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Repair every conversation; returns the edits in order and one summary row a conversation.

    The edits are as from ``repaired_rows``; a conversation with many rows spreads over many tasks. The summary has ``k``,
    ``conv_id``, ``gaps`` (missing numbers between the least and the greatest known turn), ``blank``, ``duplicate``,
    ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose initials are none of su, ua, au), ``cost`` and
    ``audit`` (the initials of the edits).

    Null conversation ids are one conversation. Null turns come first and count in no gap; a null role or text is one space.
    Rows that agree in turn are ordered by role and text; repeated rows are duplicates. An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    rows = coded_rows(df, conv, turn, role, text)
    coded = stage(faulty_rows(rows), "faulty-rows")
    edits, costs = repaired_blocks(coded)
    edits = stage(edits, "edits")
    counted = [F.count_if(F.col("fault") == i).alias(name) for i, name in enumerate(FAULTS) if i]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    totals = coded.groupBy("k").agg(*counted).join(coded.groupBy("k").agg(gaps.cast("long").alias("gaps")), "k")
    letters = F.translate(F.array_join("tokens", ""), "ua", "")
    audits = edits.groupBy("k").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", letters.alias("a")))), lambda x: x["a"]), "").alias("audit"))
    names = rows.groupBy("k").agg(F.first("conv_id").alias("conv_id"))
    summary = names.join(totals, "k").join(costs, "k").join(audits, "k")
    return repaired_rows(rows, edits), summary.select("k", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """``k, repaired_sha256``: SHA-256 of the repaired ``role:text`` lines, joined by line feeds.

    The digest of one conversation is sequential by nature: its rows pass one task in order, as a stream, and none is held.
    """
    def digest(batches):
        import hashlib

        import pandas as pd

        key, state, lines = None, None, 0
        for batch in batches:
            out = []
            for k, role, text in zip(batch["k"], batch["role"], batch["text"]):
                if k != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state, lines = k, hashlib.sha256(), 0
                if role is not None:
                    state.update((("\n" if lines else "") + f"{role}:{text}").encode())
                    lines += 1
            yield pd.DataFrame(out, columns=["k", "repaired_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["k", "repaired_sha256"])

    ordered = repaired.repartition("k").sortWithinPartitions("k", "g", "place").select("k", "role", "text")
    return ordered.mapInPandas(digest, "k string, repaired_sha256 string")
