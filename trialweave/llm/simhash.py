"""SimHash near-duplicates through deletion variants.

Fingerprints within a few bits of each other are found by equality. A fingerprint is cut into few segments, so few that of
two linked fingerprints one segment differs by at most one bit. Every segment is indexed once per bit with that bit
blanked (a one-wildcard variant); two such segments share a variant. Equal variants are joined and verified.

``linked_fingerprints`` does so with a guarantee for 64 bits and a small radius. ``near_copies`` serves a similarity of
shingle sets, whose fingerprints lie too far apart for a guarantee: longer fingerprints give many segments, of which one
matches with high probability, and candidates are verified by their shingles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.common import free_name, short_batches, split_by_keys
from trialweave.llm.graphs import components
from trialweave.session import stage

SEED = 42
HALF = 32
# Variant groups up to this size are joined pair by pair.
SMALL_GROUP = 24
# The same for near copies. Texts that agree by chance make smaller groups, so what is above holds families.
NEAR_GROUP = 4

# Rounds in which each near copy is compared with leaders of its groups only, before all that is left is compared.
LEADER_ROUNDS = 2

NEAR_WIDTH = 5
NEAR_SIMILARITY = 0.8
NEAR_LANES = 12
# Segments get a bit longer each time the documents double beyond 2^20, so that chance does not fill the groups of a variant.
SEGMENT_BITS = 22
LONGEST_SEGMENT = 30
# Share of the bits in which a pair at similarity 0.8 differs, and how many of such pairs may agree in no segment but for a bit.
DIFFERING = 116 / 768
MISSED = 0.008
# Of 768 bits a pair at similarity 0.8 differs in 116, give or take 10: beyond the one bound pairs are taken for less similar,
# within the other for more; between them the shingles decide.
FAR_BITS = 150
SURE_BITS = 76
# Of two lanes, 128 bits, such a pair differs in 19, give or take 4; unlike texts in 64, give or take 6.
LIKELY_BITS = 46
# Below so many shingles the bits are too coarse for either bound.
FEW_SHINGLES = 40
# Frequent shingles whose counts order the shingles of crowded groups. Any order finds all pairs, so the bound costs time only.
FREQUENT_SHINGLES = 200_000


def shingle_hasher(width: int):
    """A function from a text to the XXH64 hashes of its word shingles, repeats included."""
    from itertools import repeat

    import numpy as np
    from xxhash import xxh64_intdigest

    def hashes(text):
        words = text.encode("utf-8").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(words) <= width:
            return np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - width + 1)

    return hashes


def bit_counter(lanes: int):
    """A function from hashes to how many of them set each of 64 * lanes bits. Lane 0 are the hashes themselves."""
    import numpy as np

    steps = np.array([(0x9E3779B97F4A7C15 * lane) & (2**64 - 1) for lane in range(1, lanes)], np.uint64)

    def counts(hashes, part=4080):
        sums = np.zeros(64 * lanes, np.int64)
        for at in range(0, len(hashes), part):
            h = hashes[at:at + part, None]
            if lanes > 1:
                more = h + steps
                more = (more ^ (more >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                more = (more ^ (more >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                h = np.concatenate([h, more ^ (more >> np.uint64(31))], axis=1)
            bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8), axis=1, bitorder="little")
            # Sums of up to 255 rows fit in a byte, which adds many at once.
            for i in range(0, len(bits), 255):
                sums += np.add.reduce(bits[i:i + 255], axis=0, dtype=np.uint8)
        return sums

    return counts


def fingerprints(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and a 64-bit ``fp``: a bit is set if more than half the shingle hashes have it. No words: zero."""
    short_batches(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pandas as pd

        hashes, counts = shingle_hasher(width), bit_counter(1)
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                h = hashes(t)
                out.append(np.packbits(counts(h) * 2 > len(h), bitorder="little").view(np.int64)[0] if len(h) else 0)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": np.array(out, dtype=np.int64)})

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, f"doc_id {kind}, fp long")


def in_groups(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once, with the number of its rows as ``n``."""
    return rows.withColumn("n", F.count("*").over(Window.partitionBy(key))).where("n > 1")


def linked_fingerprints(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between the ``rep`` of distinct fingerprints ``fp`` that differ in at most two bits.

    Two segments of 32 bits: if two bits differ, one segment differs in at most one. Large groups of a variant, as near
    copies by the thousand make, are not joined pair by pair: two fingerprints are within two bits exactly if flipping at
    most one bit of each gives a common value, so their members meet at those values, 65 rows each.
    """
    variants = nodes.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(63)))).select(
        "fp", "rep", F.expr(f"shiftleft(cast(i as bigint), {HALF}) | (shiftrightunsigned(fp, if(i < {HALF}, 0, {HALF})) & 4294967295L"
                            f" & ~shiftleft(1L, i % {HALF}))").alias("k"))
    shared = stage(in_groups(variants, "k"), "variants")
    small = shared.where(F.col("n") <= SMALL_GROUP)
    a, b = small.select("k", F.col("fp").alias("fa"), F.col("rep").alias("a")), small.select("k", F.col("fp").alias("fb"), F.col("rep").alias("b"))
    # Of the variants that agree only the blanked bit's own one, or the first of equal segments, makes the pair.
    differ = F.expr(f"shiftrightunsigned(fa ^ fb, if(shiftright(k, {HALF}) < {HALF}, 0, {HALF})) & 4294967295L")
    place = F.expr(f"cast(shiftright(k, {HALF}) % {HALF} as int)")
    once = (differ == F.expr(f"shiftleft(1L, cast(shiftright(k, {HALF}) % {HALF} as int))")) | ((differ == 0) & (place == 0))
    close = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= 2
    pairs = a.join(b, "k").where((F.col("a") < F.col("b")) & close & once).select("a", "b")
    crowded = shared.where(F.col("n") > SMALL_GROUP).select("fp", "rep").distinct()
    flips = crowded.withColumn("i", F.explode(F.sequence(F.lit(-1), F.lit(63)))).select(
        "rep", F.expr("if(i < 0, fp, fp ^ shiftleft(1L, i))").alias("value"))
    met = in_groups(flips, "value").withColumn("b", F.min("rep").over(Window.partitionBy("value"))).select(F.col("rep").alias("a"), "b")
    return pairs.unionByName(met.where("a <> b"))


def fingerprint_classes(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``fingerprint`` in hex and ``component_id``, the smallest key it is linked to.

    Documents whose fingerprints differ in at most two bits are linked, chains included. Null and empty texts have the
    fingerprint zero and are linked like any other; texts shorter than a shingle are one shingle. A null key belongs to the class
    of the keys with its own fingerprint, null if there are none. Repeated rows stay; an empty table gives none; other
    columns are not read. Equal fingerprints are one node, so a hot group of copies costs a single one.
    """
    rows = stage(fingerprints(docs, width, key, text), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    classes = components(linked_fingerprints(nodes.where(F.col("rep").isNotNull())))
    named = nodes.join(classes, nodes["rep"] == classes["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def segment_shape(rows: int) -> tuple[int, int, int]:
    """Bits of a segment, number of segments and lanes of 64 bits for so many documents.

    The longer the segments the more of them are needed: their number keeps the share of pairs missed at the similarity asked for below ``MISSED``.
    """
    bits = min(LONGEST_SEGMENT, max(SEGMENT_BITS, (max(rows, 1) - 1).bit_length() + 2))
    agree = (1 - DIFFERING) ** bits + bits * DIFFERING * (1 - DIFFERING) ** (bits - 1)
    segments = math.ceil(math.log(MISSED) / math.log(1 - agree))
    return bits, segments, max(NEAR_LANES, -(-bits * segments // 64))


def near_signatures(docs: DataFrame, key: str, text: str, shape: tuple[int, int, int]) -> DataFrame:
    """Per document ``fps`` (lanes of 64 bits) over its ``n`` distinct shingles, ``hash`` of its text, ``digest`` of its words, and the ``bits`` of each segment of the fingerprint."""
    short_batches(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pandas as pd
        from xxhash import xxh3_128_hexdigest

        width, segments, lanes = shape
        hashes, counts = shingle_hasher(NEAR_WIDTH), bit_counter(lanes)
        place = np.left_shift(np.int32(1), np.arange(width, dtype=np.int32))
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                h = np.unique(hashes(t))
                bits = counts(h) * 2 > len(h)
                value = (bits[:segments * width].reshape(segments, width) * place).sum(axis=1, dtype=np.int32)
                words = b" ".join(t.encode("utf-8").lower().split()) if t else b""
                out.append((np.packbits(bits[:64 * NEAR_LANES], bitorder="little").view(np.int64), len(h), xxh3_128_hexdigest(words), value))
            part = pd.DataFrame(out, columns=["fps", "n", "digest", "bits"])
            part.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            part.insert(1, "hash", pdf["hash"].to_numpy())
            yield part

    kind = dict(docs.dtypes)[key]
    slim = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    return slim.mapInPandas(run, f"doc_id {kind}, hash long, fps array<long>, n int, digest string, bits array<int>")


def shingle_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``node`` and its distinct shingle hashes."""
    def run(batches):
        import numpy as np
        import pandas as pd

        hashes = shingle_hasher(NEAR_WIDTH)
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "sh": [np.unique(hashes(t)).view(np.int64) for t in pdf["text"]]})

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("node"), F.col(text).alias("text")).mapInPandas(run, f"node {kind}, sh array<long>")


def texts_of(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """``node`` and its ``text`` for ``nodes`` given with the key ``rep`` and the ``hash`` of a row that holds it; few other texts are shuffled."""
    known = nodes.select("node", F.col("rep").alias("r"), F.col("hash").alias("h"))
    slim = docs.select(F.col(key).alias("rep"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    some, _ = split_by_keys(slim, ["rep", "hash"], known.select("r", "h"))
    return some.join(known, (F.col("rep") == F.col("r")) & (F.col("hash") == F.col("h"))).select("node", "text")


def differing_bits(a: str, b: str) -> Column:
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(NEAR_LANES)))


def similar_pairs(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar. Fingerprints settle those far apart and those all but equal."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("fps").alias(f"f{name}"), F.col("n").alias(f"n{name}"))

    far = differing_bits("fa", "fb")
    few = F.least("na", "nb") < FEW_SHINGLES
    compared = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("na", "nb") >= NEAR_SIMILARITY * F.greatest("na", "nb")).withColumn("bits", far)
    near = stage(compared.where(few | (F.col("bits") <= FAR_BITS)).select("a", "b", (~few & (F.col("bits") <= SURE_BITS)).alias("sure")), "near-pairs")
    open_ = near.where("NOT sure").select("a", "b")
    wanted = open_.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = stage(nodes.select("node", "rep", "hash").join(wanted, "node", "left_semi"), "open-nodes")
    sets = stage(shingle_sets(texts_of(docs, known, key, text), "node", "text").dropDuplicates(["node"]), "shingle-sets")
    both = open_.join(sets.select(F.col("node").alias("a"), F.col("sh").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("sh").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = both.where(common >= NEAR_SIMILARITY * (F.size("sa") + F.size("sb") - common)).select("a", "b")
    return near.where("sure").select("a", "b").unionByName(alike)


def shared_variants(nodes: DataFrame, width: int) -> DataFrame:
    """``node`` and ``k`` of every variant that other nodes have too, with the ``size`` of its group and ``near``, the likely pairs of a small one.
    The node's two lanes ``l0`` and ``l1`` and number ``n`` of shingles come along, so that its group can judge it without a join.

    Variants are those of all segments of ``width`` bits with every single bit blanked. A variant goes to its task by the half of the segment that is
    whole, so that two rows a segment are shuffled and the blanked halves are made where they meet. Of a group of at most ``NEAR_GROUP``
    nodes ``near`` has those before the node that it may be similar to; groups that are larger or have such pairs are returned.
    """
    low = width // 2
    halves = F.expr(f"array(struct(0 as side, shiftright(v, {low}) as whole, v & {(1 << low) - 1} as part), struct(1 as side, v & {(1 << low) - 1} as whole, shiftright(v, {low}) as part))")
    slim = [F.col("fps")[0].alias("l0"), F.col("fps")[1].alias("l1"), "n"]
    segments = nodes.where("n > 0").select("node", *slim, F.posexplode("bits").alias("i", "v"))
    routed = segments.select("node", "l0", "l1", "n", "i", F.explode(halves).alias("h")).select(
        "node", "l0", "l1", "n", F.expr("shiftleft(2 * i + h.side, 16) | h.whole").alias("r"), F.col("h.part").alias("part")).repartition("r")
    blanked = F.expr(f"transform(sequence(0, if(shiftright(r, 16) % 2 = 0, {low}, {width - low}) - 1), p -> shiftleft(p, 16) | (part & ~shiftleft(1, p)))")
    variants = routed.select("node", "l0", "l1", "n", "r", F.explode(blanked).alias("p"))
    group = Window.partitionBy("r", "p")
    shared = variants.withColumn("size", F.count("*").over(group)).where("size > 1")
    before = F.collect_list(F.struct("node", "l0", "l1", "n")).over(group.orderBy("node").rowsBetween(1 - NEAR_GROUP, -1))
    likely = F.expr(f"transform(filter(before, x -> bit_count(x.l0 ^ l0) + bit_count(x.l1 ^ l1) <= {LIKELY_BITS}"
                    f" AND least(x.n, n) >= {NEAR_SIMILARITY} * greatest(x.n, n)), x -> x.node)")
    met = shared.withColumn("before", before).select("node", "l0", "l1", "n", F.expr("shiftleft(cast(r as bigint), 32) | p").alias("k"), "size",
                                                     F.when(F.col("size") <= NEAR_GROUP, likely).alias("near"))
    return met.where((F.col("size") > NEAR_GROUP) | (F.size("near") > 0))


def in_classes(members: DataFrame, classes: DataFrame | None, node: str = "node", c: str = "c") -> DataFrame:
    """``members`` with the component ``c`` that ``node`` is known to be in."""
    if classes is None:
        return members.withColumn(c, F.col(node))
    known = classes.select(F.col("node").alias("known"), "component")
    return members.join(known, F.col(node) == F.col("known"), "left").withColumn(c, F.coalesce("component", node)).drop("known", "component")


def group_leaders(crowded: DataFrame) -> DataFrame:
    """One row per ``node`` with ``of``, the leaders of its large variant groups: ``leader``, its negative company ``alone``, the differing ``far`` bits of two lanes, and ``likely``.

    A leader is the member with the most company in its groups, as the text has that the others were copied from. It comes to them
    by a window, so no join ever meets a whole group with itself. Likely is what any similar pair is: sizes within the similarity, and two lanes'
    bits within six standard deviations. A node has a leader per variant at most.
    """
    company = F.sum("size").over(Window.partitionBy("node"))
    lead = F.min(F.struct("alone", F.col("node").alias("leader"), "l0", "l1", "n")).over(Window.partitionBy("k"))
    led = crowded.select("node", "l0", "l1", "n", "k", (-company).alias("alone")).select("node", "l0", "l1", "n", lead.alias("f")).where("node <> f.leader")
    far = F.expr("bit_count(l0 ^ f.l0) + bit_count(l1 ^ f.l1)")
    likely = (far <= LIKELY_BITS) & (F.least("n", "f.n") >= NEAR_SIMILARITY * F.greatest("n", "f.n"))
    pairs = led.groupBy("node", F.col("f.leader").alias("leader")).agg(F.min("f.alone").alias("alone"), F.min(far).alias("far"), F.bool_or(likely).alias("likely"))
    return pairs.groupBy("node").agg(F.collect_list(F.struct("leader", "alone", "far", "likely")).alias("of"))


def leader_classes(met: DataFrame, classes: DataFrame) -> DataFrame:
    """A row per ``leader`` and class ``c`` that its members were in when ``met`` was written, with the class ``now`` and whether one of them is ``likely``.

    Classes only ever join, so members that were in one stay together.
    """
    return in_classes(met.groupBy("leader", "c").agg(F.bool_or("likely").alias("likely")), classes, "c", "now")


def leaders_apart(met: DataFrame, classes: DataFrame) -> DataFrame:
    """The nodes with a likely leader that they are not connected to, and ``of``, those leaders."""
    known = in_classes(leader_classes(met, classes).where("likely"), classes, "leader", "d")
    apart = met.where("likely").join(known.where("now <> d").select("leader", "c"), ["leader", "c"], "left_semi")
    return apart.groupBy("node").agg(F.collect_list(F.struct("leader", "alone", "far", "likely")).alias("of"))


def leader_pairs(leaders: DataFrame) -> DataFrame:
    """(a, b): of the leaders given for each node b the likely one with the most company and the nearest one, so two pairs per node at most."""
    def least(by: str) -> Column:
        return F.array_min(F.transform(F.filter("of", lambda x: x["likely"]), lambda x: F.struct(x[by], x["leader"].alias("leader"))))["leader"]

    best = leaders.select(F.col("node").alias("b"), F.array_compact(F.array_distinct(F.array(least("alone"), least("far")))).alias("x"))
    return best.select(F.explode("x").alias("a"), "b")


def small_group_pairs(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): the likely pairs of variant groups of at most ``NEAR_GROUP`` members that are not connected yet."""
    pairs = shared.where(F.size("near") > 0).select(F.explode("near").alias("a"), F.col("node").alias("b")).distinct()
    return in_classes(in_classes(pairs, classes, "a", "ca"), classes, "b", "cb").where("ca <> cb").select("a", "b")


def rarest_shingles(sets: DataFrame) -> DataFrame:
    """``node``, the size ``m`` of its shingle set and ``rare``, its rarest shingles in their order.

    All sets are ordered alike, by frequency and value. Two sets as similar as ``NEAR_SIMILARITY`` share one of the shingles given here.
    """
    counts = sets.select(F.explode("sh").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > SMALL_GROUP)
    frequent = sorted((r["shingle"], r["n"]) for r in counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT_SHINGLES).collect())
    known, often = [s for s, _ in frequent], [n for _, n in frequent]

    def run(batches):
        import math

        import numpy as np
        import pandas as pd

        values, weights = np.array(known, np.int64), np.array(often, np.int64)
        for pdf in batches:
            out = []
            for sh in pdf["sh"]:
                sh = np.asarray(sh, np.int64)
                rank = np.zeros(len(sh), np.int64)
                if len(values):
                    at = np.minimum(np.searchsorted(values, sh), len(values) - 1)
                    rank = np.where(values[at] == sh, weights[at], 0)
                length = len(sh) - math.ceil(NEAR_SIMILARITY * len(sh) - 1e-6) + 1
                out.append(sh[np.lexsort((sh, rank))[:length]])
            yield pd.DataFrame({"node": pdf["node"], "m": np.array([len(sh) for sh in pdf["sh"]], np.int32), "rare": out})

    kind = dict(sets.dtypes)["node"]
    return sets.mapInPandas(run, f"node {kind}, m int, rare array<long>")


def crowded_pairs(crowded: DataFrame, met: DataFrame, nodes: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b): all pairs out of large variant groups that may be similar and are not connected yet; repeats included.

    Similar sets share a shingle among their rarest (prefix filter), which loses no pair, however large the groups are. Groups whose members are
    connected already are done: if two members are not, one is not connected to the leader. Of a shingle's nodes those of its largest component
    are not paired among themselves, and fingerprints too far apart are not paired at all.
    """
    placed = in_classes(crowded.groupBy("node").agg(F.sum("size").alias("company")), classes)
    # One node speaks for each component, so that texts left alone meet the one their family was copied from.
    hubs = placed.groupBy("c").agg(F.max(F.struct("company", "node"))["node"].alias("node")).select("node")
    # A row per leader, not per pair, meets the leader's class.
    led = leader_classes(met, classes).groupBy("leader").agg(F.min("now").alias("least"), F.max("now").alias("most"))
    open_ = stage(in_classes(led, classes, "leader", "d").where("least <> d OR most <> d").select("leader"), "open-leaders")
    left = met.join(open_, "leader", "left_semi").select("node").unionByName(open_.select(F.col("leader").alias("node"))).unionByName(hubs).distinct()
    known = in_classes(nodes.select("node", "rep", "hash", "fps").join(left, "node", "left_semi"), classes)
    members = stage(known, "crowded-nodes")
    sets = stage(shingle_sets(texts_of(docs, members, key, text), "node", "text").dropDuplicates(["node"]), "crowded-sets")
    rare = stage(rarest_shingles(sets).join(members, "node"), "rarest").select("node", "m", "fps", "c", F.posexplode("rare").alias("place", "shingle"))
    sizes = rare.groupBy("shingle", "c").agg(F.count("*").alias("s"))
    most = sizes.groupBy("shingle").agg(F.max(F.struct("s", "c")).alias("x"), F.sum("s").alias("all")).where(F.col("all") > F.col("x.s")).select("shingle", F.col("x.c").alias("main"))
    rows = stage(rare.join(most, "shingle").select("shingle", "node", "m", "place", "fps", "c", (F.col("c") == F.col("main")).alias("main")), "rare-shingles")
    x, y = (rows.select("shingle", *[F.col(c).alias(c + side) for c in ("node", "m", "place", "fps", "c", "main")]) for side in "ab")
    common = F.ceil(NEAR_SIMILARITY / (1 + NEAR_SIMILARITY) * (F.col("ma") + F.col("mb")) - 1e-6)
    early = (F.col("placea") <= F.col("ma") - common) & (F.col("placeb") <= F.col("mb") - common)
    once = ~F.col("maina") & (F.col("mainb") | (F.col("nodea") < F.col("nodeb")))
    near = (F.least("ma", "mb") < FEW_SHINGLES) | (differing_bits("fpsa", "fpsb") <= FAR_BITS)
    met = x.join(y, "shingle").where(once & early & (F.col("ca") != F.col("cb")) & near)
    return met.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b"))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with a key: ``doc_id``, ``hash`` of its text, ``component_id``, the smallest key of its group, and ``component_hash``, the least hash of the group's texts with that key.

    A group: documents whose sets of five-word shingles are at least 0.8 similar (Jaccard), chains included. Texts with equal words,
    letter case aside, are one node; texts without words are copies of each other. Of 768 bits the fingerprints of such
    a pair differ in 116 on average, too many for a guarantee by segments of a useful length: of the 34 segments of 22 bits one differs by at most
    one bit, whichever, with a probability of about 0.99 at similarity 0.8. More documents have longer and more segments. A member of a large variant
    group is compared with the group's leader, in a few rounds with two of them at most; then small groups are compared whole, and in groups above
    ``NEAR_GROUP`` all members that are not connected yet are found by their rarest shingles.
    Texts that share a key are compared like any others, each in its own group. Null keys have no row; an empty table gives none; other columns are not read.
    """
    shape = segment_shape(docs.count())
    rows = stage(near_signatures(docs, key, text, shape), "near-signatures")
    # A node is a text, by number: keys may be shared by texts.
    least = rows.groupBy(F.col("digest").alias("d")).agg(F.min("doc_id").alias("rep"))
    own = rows.join(least, (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("rep"))).groupBy("d", "rep").agg(
        F.min("hash").alias("hash"), *[F.first(c).alias(c) for c in ("fps", "n", "bits")])
    nodes = stage(own.withColumnRenamed("d", "digest").withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    shared = stage(shared_variants(nodes, shape[0]), "near-variants")
    crowded = shared.where(F.col("size") > NEAR_GROUP)
    leaders = stage(group_leaders(crowded), "near-leaders")
    edges, met, apart = None, None, leaders
    for _ in range(LEADER_ROUNDS):
        found = stage(similar_pairs(leader_pairs(apart), nodes, docs, key, text), "near-edges")
        edges = found if edges is None else edges.unionByName(found)
        classes = stage(components(edges), "near-classes")
        # A node meets its class once, whatever the number of its leaders; from then on classes meet classes.
        met = met or stage(in_classes(leaders, classes).select("node", "c", F.inline("of")), "near-met")
        apart = leaders_apart(met, classes)
    edges = stage(edges.unionByName(similar_pairs(small_group_pairs(shared, classes), nodes, docs, key, text)), "near-edges")
    classes = stage(components(edges), "near-classes")
    rest = crowded_pairs(crowded, met, nodes, classes, docs, key, text).distinct()
    linked = stage(components(edges.unionByName(similar_pairs(rest, nodes, docs, key, text))), "near-classes")
    placed = nodes.select("digest", "node", "rep", "hash").join(linked, "node", "left").select("digest", "rep", "hash", F.coalesce("component", "node").alias("c"))
    first = placed.groupBy("c").agg(F.min(F.struct(F.col("rep").alias("component_id"), F.col("hash").alias("component_hash"))).alias("x")).select("c", "x.*")
    named = placed.select("digest", "c").join(first, "c").drop("c")
    return rows.join(named, "digest").select("doc_id", "hash", "component_id", "component_hash")


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that with the smallest key; rows with a null key stay.

    Of rows that agree in key and text one stays, and of a group's texts that share its smallest key that with the least hash.
    """
    classes = stage(near_copies(docs, key, text), "near-decisions")
    other = (F.col("doc_id") != F.col("component_id")) | (F.col("hash") != F.col("component_hash"))
    goes = stage(classes.where(other).select(F.col("doc_id").alias("__id"), F.col("hash").alias("__h")).distinct(), "near-copies")
    mark = free_name(docs, "__hash")
    some, others = split_by_keys(docs.withColumn(mark, F.xxhash64(text)), [key, mark], goes)
    kept = others.unionByName(some.join(goes, (some[key] == goes["__id"]) & (some[mark] == goes["__h"]), "left_anti")).drop(mark)
    repeated = stage(classes.groupBy("doc_id", "hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("__id")).distinct(), "repeated-keys")
    if not repeated.head(1):
        return kept
    once = kept.join(repeated, kept[key] == repeated["__id"], "left_semi").dropDuplicates([key, text])
    return kept.join(repeated, kept[key] == repeated["__id"], "left_anti").unionByName(once)
