"""Conversation repair on small tables, against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest

from trialweave.llm import queries, turns

SCHEMA = "conv_id long, turn long, role string, text string, k string, g string, pos string, n string, block string, hit string, time string, id string, place string"
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least cost, then least letters, then what is left, by trying every edit at every place."""
    n = len(rows)
    legal = lambda done: re.fullmatch("(s?(ua)+)?", done)
    step = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}

    @cache
    def best(i, last, inserted):
        found = [(0, "", ())] if i == n and legal({"": "", "s": "s", "u": "u", "a": "ua"}[last]) else []
        if inserted < 4:
            for c, role in (("u", "user"), ("a", "assistant")):
                if c in step[last]:
                    cost, letters, lines = best(i, c, inserted + 1)
                    found.append((cost + 2, "I" + letters, (f"{role}:", *lines)))
        if i < n:
            role, text = rows[i]
            cost, letters, lines = best(i + 1, last, 0)
            found.append((cost + 3, "D" + letters, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for letter, price, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if new[:1] in step[last] and new[:1]:
                        cost, letters, lines = best(i + 1, new[:1], 0)
                        found.append((cost + price + more, letter + letters, (f"{new}:{text}", *lines)))
        return min(found) if found else (1 << 30, "", ())

    for i in range(n, 0, -1):  # from the end, so that no call goes deep
        for last in step:
            best(i, last, 0)
    return best(0, "", 0)


def brute(table):
    """What the query returns, from rows of conv_id, turn, role, text."""
    by, out = defaultdict(list), {}
    for conv, turn, role, text in table:
        by.setdefault(conv, [])
        shown = lambda x: " " if x is None else str(x)
        hit = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        by[conv] += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        plain, known = [r[1:] for r in rows], {r[0] for r in rows if r[0] is not None}
        faults = faults_of(plain)
        cost, letters, lines = cheapest(tuple(plain), tuple(faults))
        initials = [r[0][:1] for r in plain]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, letters,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 5 + ["system", "tool", None, "", "User", "s", "ünder"]
    texts = ["yes.", "no", "why?", " \t\n", "", None, "go on!", "end. \x0b", "x" * 9000, "é", "one\ntwo."]
    out = []
    for conv in range(conversations):
        turn = rng.choice([0, 0, 5])
        for _ in range(rng.randrange(1, longest)):
            out.append((conv, turn if rng.random() > 0.05 else None, rng.choice(roles), rng.choice(texts) or (None if rng.random() < 0.5 else "")))
            turn += rng.choice([0, 1, 1, 1, 1, 3])
    return out


def run(spark, rows, path):
    spark.createDataFrame([(*r, *["x"] * 9) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    got = queries.QUERIES["op13_repair"](spark, str(path))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("block", [1, 3, 64])
def test_repairs_are_the_cheapest_and_ascii_least(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(turns, "SMALLEST_BLOCK", block)
    rows = made(block, 60, 14) + [(None, 1, "user", "hm."), (None, None, None, None), (700, 0, "user", "alone")]
    # Alternating rows that need no edit, an empty one in the middle, and one row that comes back without end.
    rows += [(800, i, "user" if i % 2 == 0 else "assistant", f"line {i}.") for i in range(60)] + [(801, 3, "user", "again.")] * 40
    want = brute(rows)
    got = run(spark, rows, tmp_path)
    assert len(got) == len(want) and {r[0]: r[1:] for r in got} == want


def test_a_long_conversation_is_cut_and_put_together(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c?", " "]) + (str(i) if i % 3 else "")) for i in range(700)]
    rows += [(2, 0, "user", "short."), (2, 1, "assistant", "one.")]
    want = brute(rows)
    blocks, real = [], turns.repaired_blocks

    def watched(coded):
        edits, costs = real(coded)
        blocks.append(edits)
        return edits, costs

    monkeypatch.setattr(turns, "repaired_blocks", watched)
    got = run(spark, rows, tmp_path)
    assert {r[0]: r[1:] for r in got} == want
    assert blocks[0].where("k = '=1'").count() >= 9


def test_a_block_may_be_entered_in_any_state():
    rng = random.Random(6)
    for _ in range(200):
        codes = "".join(rng.choice(turns.CODES) for _ in range(rng.randrange(1, 30)))
        cuts = sorted({0, len(codes), *[rng.randrange(len(codes)) for _ in range(3)]})
        pieces = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
        vectors, first = turns.backward([turns.block_matrix(p) for p in pieces])
        whole, _ = turns.walk(codes, turns.FINISHED, turns.START, True)
        state, parts = turns.START, []
        for i, (p, v) in enumerate(zip(pieces, vectors)):
            tokens, state = turns.walk(p, v, state, i == len(pieces) - 1)
            parts += tokens
        assert parts == whole and first[turns.START] == turns.backward([turns.block_matrix(codes)])[1][turns.START]


def test_the_edits_hold_every_row_once(spark):
    rows = made(9, 30, 12)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits, summary = turns.repair(df)
    got = edits.collect()
    assert sum(r["edit"] != "I" for r in got) == len(rows)
    left = defaultdict(str)
    for r in sorted(got, key=lambda r: (r["k"], r["g"], r["place"])):
        left[r["k"]] += (r["role"] or "")[:1]
        assert (r["text"] is None) == (r["edit"] == "D")
    assert all(re.fullmatch("(s?(ua)+)?", done) for done in left.values())
    assert summary.count() == len({r[0] for r in rows})


def test_no_rows(spark, tmp_path):
    assert run(spark, [], tmp_path / "none") == []
    dropped = next(t for t in range(10000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert run(spark, [(5, dropped, "user", "gone")], tmp_path / "gone") == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
