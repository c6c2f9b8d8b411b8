"""Fingerprints, repeats, decontamination and surrogates on small tables, against brute force."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from trialweave.llm import benchmarks, common, graphs, repeats, simhash, surrogates
from trialweave.llm.common import split_by_keys


def prose(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    out = [(i, " ".join(prose(rng, rng.randrange(0, 90)))) for i in range(60)]
    for i in range(40):  # near copies of one text
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(120)] = "edited"
        out.append((100 + i, " ".join(copy)))
    out += [(200 + i, "  ".join(base).upper() + "\n") for i in range(3)] + [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE  "), (305, "one two")]
    out += [(400, "a " * 100), (401, "b c " * 60), (402, "x " + "a " * 50), (403, " ".join(base[20:80] + prose(rng, 40)))]
    out += [(500, " ".join(prose(rng, 30000, 5000)))] + [(100, out[60][1])] * 2 + [(None, "no key " * 20), (None, "no key " * 20)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, text string, fp string, crc string, n int").repartition(5)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("small", [2, 24])
def test_fingerprint_classes(rows, docs, small, monkeypatch):
    """With a low limit every group takes the way of large groups."""
    monkeypatch.setattr(simhash, "SMALL_GROUP", small)
    fps = {}
    for i, t in rows:
        fps.setdefault(fingerprint(t), []).append(i)
    keys, root = list(fps), {}
    for a in keys:
        root.setdefault(a, a)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in keys:
        for b in keys:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for f, ids in fps.items():
        known = [i for i in ids if i is not None]
        least[find(f)] = min([*known, least.get(find(f), 10**9)])
    expected = Counter((i, f"{f:016x}", None if all(x is None for x in ids) else least[find(f)]) for f, ids in fps.items() for i in ids)
    assert Counter(map(tuple, simhash.fingerprint_classes(docs).collect())) == expected
    assert simhash.fingerprint_classes(docs.limit(0)).count() == 0


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("small", [2, 24])
def test_near_copies_link_similar_texts_and_no_others(rows, docs, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_GROUP", small)
    monkeypatch.setattr(simhash, "NEAR_GROUP", small)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in sets}


def test_pairs_of_a_template_family_unlike_its_leader_are_linked(spark):
    """Some thousand rows of one template, each too unlike the others, hold pairs that are near copies."""
    rng = random.Random(8)
    base = prose(rng, 300, 10**6)

    def variant(words, edits):
        words = list(words)
        for p in rng.sample(range(0, 300, 6), edits):
            words[p] = f"own{rng.randrange(10**9)}"
        return words

    family = [variant(base, 12) for _ in range(2500)]
    pairs = {1000 + i: 10000 + i for i in range(0, 1500, 30)}
    texts = {i: " ".join(w) for i, w in enumerate(family)}
    for i, (a, b) in enumerate(pairs.items()):
        copy = family[a].copy()
        for p in range(3, 3 + 6 * (1 + i % 3), 6):
            copy[p] = f"copy{a}"
        texts[b] = " ".join(copy)
    sets = {i: shingle_set(t) for i, t in texts.items()}
    assert all(len(sets[0] & sets[a]) < 0.8 * len(sets[0] | sets[a]) and len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b]) for a, b in pairs.items())
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)).collect()}
    linked = sum(got[a] == got[b] for a, b in pairs.items())
    assert linked == len(pairs), linked


def test_one_of_each_group_stays(rows, docs):
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[100] == 1 and not any(ids[200 + i] for i in range(3)) and ids[None] == 2
    blank = [i for i, t in rows if i is not None and not (t or "").split()]
    assert len(blank) > 3 and [i for i in blank if ids[i]] == [min(blank)]
    assert all(ids[i] for i in range(60) if len(dict(rows[:60])[i].split()) > 8) and ids[500] == 1
    assert simhash.without_near_copies(docs.limit(0)).count() == 0


def test_texts_that_share_a_key_are_compared_each(spark):
    """A copy of any text of a repeated key goes, and no text goes for a copy of another text of its key."""
    rng = random.Random(21)
    rows, want = [], Counter()
    for i in range(12):
        texts = [prose(rng, 80, 10**6) for _ in range(3)]
        # Key 100 + i has three texts: copies of the third have smaller and larger keys, one of the first the same key.
        for key, j, edited in [(100 + i, 0, ""), (100 + i, 1, ""), (100 + i, 2, ""), (i, 2, "x"), (100 + i, 0, "x"), *((200 + 10 * i + j, j, "y") for j in range(3))]:
            rows.append((key, " ".join([*texts[j], edited])))
        want.update([(100 + i, texts[0][40]), (100 + i, texts[1][40]), (i, texts[2][40])])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter((r["doc_id"], r["text"].split()[40]) for r in simhash.without_near_copies(docs).collect()) == want


def test_few_texts_are_shuffled_for_a_join_with_few_keys(spark, monkeypatch):
    rows = [(i if i % 50 else None, i % 3, f"text {i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, __place long, text string").repartition(4)
    wanted = [*((i, i % 3) for i in range(0, 20_000, 10)), (None, 0), (-1, 0)]
    keys = spark.createDataFrame(wanted, "a long, b long")
    some, others = (x.collect() for x in split_by_keys(df, ["doc_id", "__place"], keys))
    assert Counter(some + others) == Counter(df.collect()) and some[0].__fields__ == df.columns
    assert not {(r[0], r[1]) for r in others} & set(wanted) and len(others) > 0.85 * len(rows)
    none, all_ = split_by_keys(df, ["doc_id", "__place"], keys.limit(0))
    assert none.count() == 0 and all_.count() == len(rows)
    # A filter that is too small lets more through and loses none.
    monkeypatch.setattr(common, "BITMAP_BITS", 8)
    monkeypatch.setattr(common, "MOST_BITMAPS", 600)
    some, others = (x.collect() for x in split_by_keys(df, ["doc_id", "__place"], keys))
    assert len(some) + len(others) == len(rows) and others and not {(r[0], r[1]) for r in others} & set(wanted)


def test_near_copies_go_without_a_shuffle_of_the_texts_that_stay(spark):
    rng = random.Random(4)
    texts = [prose(rng, 60, 10**6) for _ in range(300)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000 + i, " ".join(t)) for i, t in enumerate(texts[:20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash.without_near_copies(docs)
        union = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert sum("Union" in line for line in union) == 1 and sum("LeftAnti" in line for line in union) == 1
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_leaders_meet_their_class_once_each(spark, monkeypatch):
    """Not once for every member of their groups."""
    rng = random.Random(6)
    base = prose(rng, 200, 10**6)
    family = [[f"own{rng.randrange(10**9)}" if p in (i % 40 * 5, i % 37 * 5 + 2) else w for p, w in enumerate(base)] for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(family)], "doc_id long, text string").repartition(4)
    met, plain = [], simhash.in_classes

    def in_classes(members, classes, node="node", c="c"):
        if node == "leader" and "likely" not in members.columns:
            met.append((members.count(), members.select("leader").distinct().count()))
        return plain(members, classes, node, c)

    monkeypatch.setattr(simhash, "in_classes", in_classes)
    assert {r["component_id"] for r in simhash.near_copies(docs).collect()} == {0}
    assert len(met) == 1 and met[0][0] == met[0][1] > 0


def test_a_node_meets_its_class_once_whatever_the_number_of_its_leaders(spark, monkeypatch):
    rng = random.Random(6)
    base = prose(rng, 200, 10**6)
    family = [[f"own{rng.randrange(10**9)}" if p in (i % 40 * 5, i % 37 * 5 + 2) else w for p, w in enumerate(base)] for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(family)], "doc_id long, text string").repartition(4)
    met, most, plain, group = [], [], simhash.in_classes, simhash.group_leaders

    def in_classes(members, classes, node="node", c="c"):
        if node == "node" and classes is not None:
            met.append((members.count(), members.select("node").distinct().count()))
        return plain(members, classes, node, c)

    def group_leaders(*given):
        led = group(*given)
        most.extend(r["n"] for r in led.select(F.size("of").alias("n")).collect())
        return led

    monkeypatch.setattr(simhash, "in_classes", in_classes)
    monkeypatch.setattr(simhash, "group_leaders", group_leaders)
    assert {r["component_id"] for r in simhash.near_copies(docs).collect()} == {0}
    assert max(most) > 3 and len(met) == 3 and all(rows == nodes > 0 for rows, nodes in met), met


def test_leaders_that_a_node_is_connected_to_are_left_out(spark):
    """Also where classes have joined since the pairs were written."""
    rng = random.Random(7)
    early = {i: min(i, i // 3 * 3) for i in range(60)}
    late = {i: early[i] // 12 * 12 if i < 48 else early[i] for i in early}
    pairs = {(rng.randrange(60), rng.randrange(60)): (-rng.randrange(5), rng.randrange(60), rng.random() < 0.7) for _ in range(400)}
    pairs = {k: v for k, v in pairs.items() if k[0] != k[1]}
    met = spark.createDataFrame([(a, early[a], b, *v) for (a, b), v in pairs.items()], "node long, c long, leader long, alone long, far int, likely boolean").repartition(3)
    classes = [spark.createDataFrame([(i, c) for i, c in x.items() if i != c], "node long, component long") for x in (early, late)]
    for table, known in zip(classes, (early, late)):
        got = {(r["node"], r["leader"]) for r in simhash.leaders_apart(met, table).select("node", F.inline("of")).collect()}
        assert got == {(a, b) for (a, b), v in pairs.items() if v[2] and known[a] != known[b]} and got
    whole = met.groupBy("node").agg(F.collect_list(F.struct("leader", "alone", "far", "likely")).alias("of"))
    want = set()
    for a in early:
        of = [(v[0], v[1], b) for (x, b), v in pairs.items() if x == a and v[2]]
        want |= {(min((y[0], y[2]) for y in of)[1], a), (min((y[1], y[2]) for y in of)[1], a)} if of else set()
    got = [tuple(r) for r in simhash.leader_pairs(whole).select("a", "b").collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("part", [400, 10**6])
def test_repeated_windows_are_removed(rows, docs, part, monkeypatch):
    """With small parts texts meet only in the exchange."""
    monkeypatch.setattr(repeats, "PART_CHARS", part)
    seen = Counter()
    for _, t in rows:
        w = (t or "").encode().split()
        seen.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
    expected = Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - 34):
            if seen[tuple(w[p:p + 35])] > 1:
                gone.update(range(p, p + 35))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        expected[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(map(tuple, repeats.remove_repeats(docs).collect())) == expected
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_equal_passages_share_their_inner_symbols():
    rng = random.Random(1)
    shared = [f"s{i}".encode() for i in range(60)]
    lists = [[b"x%d" % rng.randrange(99) for _ in range(40)] + shared + [b"y%d" % rng.randrange(99) for _ in range(40)] for _ in range(2)]
    starts, owner, symbol, own = repeats.recompressor(35)(lists)
    at = [{int(s) - o * 140: (int(x), int(h)) for s, o, x, h in zip(starts, owner, symbol, own) if o == k} for k in (0, 1) for o in [k]]
    assert all(at[0][p] == at[1][p] for p in range(40, 66))
    # Far fewer symbols than windows: a symbol stands for a stretch.
    assert len({at[0][p][0] for p in range(40, 66)}) < 13


def test_windows_of_one_symbol_are_compared_by_all_bits_of_their_hash(spark):
    """Hashes that differ in their highest byte only are no repeat, those that agree in all are."""
    rows = [(1, 0x11_0000_0000_00AA), (2, 0x7F_0000_0000_00AA), (3, 0x11_0000_0000_00AA), (4, 0x11_0000_0000_00AA | 1 << 63)]
    at = [(9, i, 0, 4, 1, bytearray(h.to_bytes(8, "little")[:repeats.HASH_BYTES])) for i, h in rows]
    filed = spark.createDataFrame(at, "symbol long, doc_id long, crc long, first int, n int, hashes binary")
    assert sorted(r["doc_id"] for r in repeats.repeated_stretches(filed, 35, 4).collect()) == [1, 3]


def test_windows_of_a_hot_symbol_spread_and_repeats_stay_found(spark, monkeypatch):
    """One line in all rows, with other words around it, files many windows under few symbols."""
    rng = random.Random(6)
    line = [f"line{i}" for i in range(24)]
    texts = [" ".join(prose(rng, 30, 10**6) + line + prose(rng, 30, 10**6)) for _ in range(400)]
    texts += [texts[3] + " tail"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = df.select("doc_id", F.crc32("text").alias("crc"), "text")
    expected = sorted(map(tuple, repeats.remove_repeats(df).collect()))
    monkeypatch.setattr(repeats, "HOT_WINDOWS", 300)
    monkeypatch.setattr(repeats, "HOT_SAMPLE", 1)

    def largest(hot):
        filed = repeats.filed_windows(rows, 35, hot).where("n > 0")
        return filed.groupBy("symbol").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]

    hot = repeats.hot_symbols(rows, 35)
    assert hot and largest([]) > 1000 and largest(hot) <= 300
    got = sorted(map(tuple, repeats.remove_repeats(df).collect()))
    assert got == expected and [r[0] for r in got if r[2]] == [3, 400]


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def shingle_bag(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_leaks_against_every_window(spark):
    rng = random.Random(9)
    items = {i: " ".join(prose(rng, rng.choice([9, 12, 30, 45]), 5000)) for i in range(12)}
    items |= {50: "tiny item", 51: "", 52: None, 53: items[3]}
    texts = {}
    for i in range(60):
        body = prose(rng, 80, 5000)
        leak = items[i % 12].split() if i % 3 else []
        for _ in range(i % 4):
            if leak:
                leak[rng.randrange(len(leak))] = "changed"
        texts[i] = " ".join(body[:i] + leak + body[i:])
    texts |= {100: None, 101: "", 102: items[2].upper().replace(" ", "... "), 103: "a TINY, item here", 104: "tiny", 105: items[4] * 2}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(102, texts[102], "x"), (None, items[1], "x")], "doc_id long, text string, item_id string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9)
           for r in benchmarks.leaks(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    expected = {}
    for i, t in texts.items():
        for j, item in items.items():
            w, m = words(t), words(item)
            if w and m:
                bag = shingle_bag(m)
                best = max(sum((shingle_bag(w[p:p + len(m)]) & bag).values()) / sum((shingle_bag(w[p:p + len(m)]) | bag).values())
                           for p in range(max(1, len(w) - len(m) + 1)))
                if best >= 0.8:
                    expected[i, j] = round(best, 9)
    assert got == expected and len(expected) > 10
    kept = benchmarks.without_leaks(docs, spark.createDataFrame([(1, items[2])], "item_id long, text string"))
    assert kept.columns == docs.columns and kept.where("doc_id = 102").count() == 0 and kept.where("doc_id IS NULL").count() == 1
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmarks.leaks(docs, none).count() == 0 and benchmarks.leaks(docs.limit(0), none).count() == 0


def test_truncated_and_swapped_items_are_leaks(spark):
    rng = random.Random(12)
    items = {1: prose(rng, 45, 10**6), 2: prose(rng, 100, 10**6), 3: prose(rng, 45, 10**6), 4: prose(rng, 120, 10**6)}
    third = items[4][80:] + items[4][:40] + items[4][40:80]
    texts = {1: items[1][:38], 2: prose(rng, 60, 10**6) + items[2][50:] + items[2][:50] + prose(rng, 60, 10**6), 3: items[3][:30],
             4: prose(rng, 9, 10**6) + third + prose(rng, 9, 10**6), 5: items[2][:50] + prose(rng, 20, 10**6) + items[2][50:]}
    expected = {}
    for i, w in texts.items():
        for j, m in items.items():
            bag = shingle_bag(m)
            best = max(sum((shingle_bag(w[p:p + len(m)]) & bag).values()) / sum((shingle_bag(w[p:p + len(m)]) | bag).values())
                       for p in range(max(1, len(w) - len(m) + 1)))
            if best >= 0.8:
                expected[i, j] = round(best, 9)
    frames = (spark.createDataFrame([(i, " ".join(w)) for i, w in x.items()], f"{k} long, text string") for k, x in (("doc_id", texts), ("item_id", items)))
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in benchmarks.leaks(*frames).collect()}
    assert got == expected and set(got) == {(1, 1), (2, 2), (4, 4)} and got[1, 1] == round(34 / 41, 9)


KEY = "test key"
PERSONAL = [
    (1, "Mr. John Smith wrote; Mary Jones and Mr. Smith read it. Frau Anna Weiß."),
    (2, "mail a.b@mail7.example.com, A.B@X.org! call +1 (017) 555-7713 or 555-7713 from 97.51.17.173"),
    (3, "card 4111111111111111 or 4111 1111 1111 1112, ssn 123-45-6789, iban DE89370400440532013000"),
    (4, "key \"908038b7daaf91e730d2f64001c52934d43d9336\" v4.0. 3. 1999 999.1.1.1"), (5, None), (6, ""), (7, "plain text"), (1, "Господин Иван Петров"),
]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates_keep_type_format_gender_and_coreference(spark):
    df = spark.createDataFrame([(*r, "x") for r in PERSONAL], "doc_id long, text string, n_entities string")
    new = surrogates.replace_entities(df, KEY)
    assert "Python" not in new._jdf.queryExecution().executedPlan().toString()
    got = [(r["doc_id"], r["text"], r["n_entities"]) for r in new.collect()]
    one, two, three, four, five, six, seven, cyrillic = [g[1] for g in got]
    found = re.match(r"Mr\. (\w+) (\w+) wrote; (\w+) (\w+) and Mr\. (\w+) read it\. Frau (\w+) (\w+)\.$", one)
    assert found[1] in surrogates.GIVEN_NAMES[0] and found[3] in surrogates.GIVEN_NAMES[1] and found[6] in surrogates.GIVEN_NAMES[1]
    assert found[2] == found[5] != "Smith" and len(found[2]) == 5 and found[1] != "John"
    assert re.search(r"mail [a-z]\.[a-z]@[a-z]{4}\d\.[a-z]{7}\.com, [A-Z]\.[A-Z]@[A-Z]\.org! call \+1 \(\d{3}\) \d{3}-\d{4} or \d{3}-\d{4} from (\d+\.){3}\d+$", two)
    assert not {"555-7713", "97.51.17.173", "example"} & set(re.findall(r"[\w.-]+", two))
    cards = re.findall(r"\d{16}|\d{4} \d{4} \d{4} \d{4}", three.split("ssn")[0])
    assert [luhn(c) for c in cards] == [True, False] and "4111" not in three and "123-45-6789" not in three and re.search(r"iban DE\d{20}$", three)
    assert re.fullmatch(r'key "[0-9a-f]{40}" v4\.0\. 3\. 1999 999\.1\.1\.1', four) and "908038b7" not in four
    assert (five, six, seven) == (None, "", "plain text") and re.fullmatch(r"Господин [А-Яа-яё]+ [А-Яа-яё]{6}", cyrillic) and "Петров" not in cyrillic
    assert surrogates.replace_entities(df, KEY).collect() == new.collect() != surrogates.replace_entities(df, "other").collect()
    assert surrogates.replace_entities(df.limit(0), KEY).count() == 0


def test_international_and_plain_phones_and_ipv6_are_replaced(spark):
    phones = ["+44 20 7946 0958", "+351 912 345 678", "+49 30 1234567", "2125551234", "+442079460958", "+1 (212) 555-1234", "+33 1 23 45 67 89", "0612345678"]
    addresses = ["2001:db8:85a3:0:0:8a2e:370:7334", "2001:db8::8a2e:370:7334", "fe80::1", "2001:DB8::"]
    plain = ["12:30:45", "std::string", "a ratio 1:2", "+12 points", "1999", "12345678901"]
    df = spark.createDataFrame([(i, f"see {e}, then") for i, e in enumerate(phones + addresses + plain)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in surrogates.replace_entities(df, KEY).collect()}
    shape = lambda e: re.sub("[A-F]", "A", re.sub("[a-f]", "a", re.sub("[0-9]", "0", e)))
    for i, e in enumerate(phones + addresses):
        new = got[i]["text"][4:-6]
        assert got[i]["n_entities"] == 1 and new != e and shape(new) == shape(e) and got[i]["text"] == f"see {new}, then", (e, got[i])
    assert all(got[len(phones + addresses) + i]["text"] == f"see {e}, then" for i, e in enumerate(plain))
    assert got[0]["text"].startswith("see +44 ") and got[1]["text"].startswith("see +351 ")


def test_different_entities_never_share_a_surrogate(spark):
    ids = spark.range(3000)
    texts = ids.select(F.concat_ws(" ", F.format_string("10.0.%d.%d", F.col("id") % 250, F.floor(F.col("id") / 250)),
                                   F.format_string("u%d@h.org", F.col("id")), F.format_string("555-%04d", F.col("id"))).alias("text"))
    table = surrogates.surrogate_table(texts, KEY)
    assert table.count() == 9000 and surrogates.collisions(texts, KEY).count() == 0


def test_texts_of_one_key_and_checksum_keep_their_own_repeats(spark):
    rng = random.Random(12)
    passage = " ".join(prose(rng, 40, 10**6))
    ends = ["".join(rng.choices(string.ascii_letters, k=9)) for _ in range(300_000)]
    long = {zlib.crc32(f"{passage} {end}".encode()): f"{passage} {end}" for end in ends}
    short = next(t for t in (f"short text {end}" for end in ends) if zlib.crc32(t.encode()) in long)
    texts = [(None, long[zlib.crc32(short.encode())]), (None, short), (7, passage)]
    got = remove_rows(spark, texts)
    assert got == sorted([(41, 40), (3, 0), (40, 40)])


def remove_rows(spark, texts):
    found = repeats.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(2)).collect()
    return sorted((r["n_words"], r["n_removed"]) for r in found)


def test_a_leak_is_found_beside_other_texts_and_items_of_its_key(spark):
    rng = random.Random(13)
    item = " ".join(prose(rng, 30, 5000))
    texts = [(1, " ".join(prose(rng, 60, 5000))) for _ in range(6)] + [(1, " ".join(prose(rng, 15, 5000)) + f" {item} " + " ".join(prose(rng, 15, 5000)))]
    items = [(5, item), (5, " ".join(prose(rng, 30, 5000))), (5, " ".join(prose(rng, 30, 5000)))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = benchmarks.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"], r["first_word"]) for r in found] == [(1, 5, 1.0, 15)]


def test_candidates_of_a_template_family_stay_few(spark, monkeypatch):
    """Copies of one text, each with edits of its own, are linked through it: no comparison of all with all."""
    rng = random.Random(14)
    base = prose(rng, 300, 10**6)
    texts = [(5000, " ".join(base))]
    for i in range(1500):
        words = list(base)
        for p in rng.sample(range(0, 300, 6), 6):
            words[p] = f"own{rng.randrange(10**9)}"
        texts.append((i, " ".join(words)))
    seen = []
    whole = simhash.similar_pairs
    monkeypatch.setattr(simhash, "similar_pairs", lambda pairs, *more: seen.append(pairs.count()) or whole(pairs, *more))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert {r["component_id"] for r in simhash.near_copies(docs).collect()} == {0}
    # All with all would be 1.1 million pairs.
    assert sum(seen) < 12 * len(texts), seen


@pytest.mark.parametrize("width", [22, 25])
def test_a_segment_that_differs_by_any_one_bit_is_shared(spark, width, monkeypatch):
    """Whichever bit of a segment differs, two nodes share a variant; with two bits they share none."""
    rng = random.Random(3)
    lanes, nodes, want = [rng.getrandbits(62) for _ in range(12)], [], set()
    for i in range(width):
        v, other = rng.getrandbits(width), rng.getrandbits(width)
        nodes += [(10 * i, lanes, 50, [v, other]), (10 * i + 1, lanes, 50, [v ^ 1 << i, ~other & (1 << width) - 1])]
        nodes += [(10 * i + 2, lanes, 50, [other ^ 1 << i ^ 1 << (i + 1) % width, rng.getrandbits(width)])]
        want.add((10 * i, 10 * i + 1))
    table = spark.createDataFrame(nodes, "node long, fps array<long>, n int, bits array<int>").repartition(3)
    near = simhash.shared_variants(table, width).select(F.explode("near").alias("a"), F.col("node").alias("b")).collect()
    assert {(r["a"], r["b"]) for r in near} == want
    monkeypatch.setattr(simhash, "NEAR_GROUP", 1)
    large = simhash.shared_variants(table, width).groupBy("k").agg(F.collect_set("node").alias("of"), F.max("size").alias("n")).collect()
    assert {tuple(sorted(r["of"])) for r in large} == want and {r["n"] for r in large} == {2}


def test_segments_grow_with_the_documents():
    shapes = {n: simhash.segment_shape(n) for n in (0, 1, 2**20, 2**20 + 1, 2**24, 2**40)}
    assert shapes[0] == shapes[1] == shapes[2**20] == (22, 34, 12) and shapes[2**20 + 1][0] == 23 and shapes[2**24][0] == 26 and shapes[2**40][0] == 30
    for bits, segments, lanes in shapes.values():
        miss = (1 - 0.849 ** bits - bits * 0.151 * 0.849 ** (bits - 1)) ** segments
        assert miss < 0.009 and 64 * lanes >= bits * segments


def test_longer_segments_link_the_same_copies(rows, docs, monkeypatch):
    want = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    monkeypatch.setattr(simhash, "SEGMENT_BITS", 25)
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()} == want
