"""URL filter: rules first, then a path-template tree per host.

Only DataFrame functions. Digits of a segment become ``#``. Level by level, a segment keeps its name only if the share of
blocked labels below it differs from that of its siblings by more than chance; all other branches merge into the
wildcard ``*``, as do segments with digits. Labels are the urls that a rule decides. A template is rejected when its
share of blocked labels, smoothed towards its host's and that towards a prior, exceeds a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import lower_ascii
from trialweave.session import stage

DEPTH = 3
Z = 2.0
STRENGTH = 4.0
PRIOR = 0.2
THRESHOLD = 0.5


def host_of(url: Column) -> Column:
    """From behind the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__u, instr(__u, '://') + 3)"))
    return lower_ascii(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__u, instr(__u, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_host_and_path(df: DataFrame, url: str) -> DataFrame:
    named = df.withColumn("__u", F.col(url))
    return named.withColumns({"host": host_of(F.col("__u")), "path": path_of(F.col("__u"))}).drop("__u")


def matched_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``; rules are (verdict, host, path)."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in reversed(longest_first):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def segments(depth: int) -> dict[str, Column]:
    """``s1`` to ``s<depth>`` of ``path``, digits as #; empty beyond the path's end. Deeper levels are not told apart."""
    parts = F.filter(F.split(F.col("path"), "/"), lambda s: s != "")
    return {f"s{i}": F.coalesce(F.regexp_replace(F.get(parts, i - 1), "[0-9]+", "#"), F.lit("")) for i in range(1, depth + 1)}


def kept_branches(leaves: DataFrame, above: list[str], segment: str, z: float) -> DataFrame:
    """Branches whose labels differ from those of all branches of their parent."""
    branches = leaves.groupBy(*above, segment).agg(F.sum("lab").alias("lab"), F.sum("blk").alias("blk"))
    parents = branches.groupBy(*above).agg(((F.sum("blk") + 1) / (F.sum("lab") + 2)).alias("p"))
    expected, p = F.col("lab") * F.col("p"), F.col("p")
    unlike = F.abs(F.col("blk") - expected) > 1 + z * F.sqrt(F.col("lab") * p * (1 - p))
    fixed = (F.col(segment) != "") & (F.instr(F.col(segment), "#") == 0)
    return branches.join(parents, above).where(unlike & fixed).select(*above, segment, F.lit(True).alias("kept"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url", depth: int = DEPTH,
          z: float = Z, strength: float = STRENGTH, prior: float = PRIOR, threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, and the template and its purity.

    A null url or one without :// has an empty host and path and the template of that host. Repeated rows stay, each
    judged alike; null keys are kept; an empty table gives none; no other column is read. A hot host only makes larger
    sums, and the tables joined to the rows hold one row per kept branch or template.
    """
    name, verdict = matched_rule(rules)
    rows = with_host_and_path(pages.select(F.col(key).alias("page_id"), F.col(url).alias("url")), "url").drop("url")
    rows = stage(rows.withColumns({"rule": name, "ruled": verdict}).withColumns(segments(depth)), "urls")
    names = [f"s{i}" for i in range(1, depth + 1)]
    leaves = rows.groupBy("host", *names).agg(F.count("ruled").alias("lab"), F.count_if(F.col("ruled") == "block").alias("blk"))
    above = ["host"]
    for i, segment in enumerate(names, 1):
        kept = kept_branches(leaves, above, segment, z)
        on = [*above, segment]
        template = F.when(F.col("kept"), F.col(segment)).when(F.col(segment) == "", F.lit("")).otherwise(F.lit("*"))
        rows = rows.join(kept, on, "left").withColumn(f"t{i}", template).drop("kept")
        leaves = leaves.join(kept, on, "left").withColumn(f"t{i}", template).groupBy("host", *[f"t{j}" for j in range(1, i + 1)], *names[i:]).agg(
            F.sum("lab").alias("lab"), F.sum("blk").alias("blk"))
        above.append(f"t{i}")
    hosts = leaves.groupBy("host").agg(((F.sum("blk") + strength * prior) / (F.sum("lab") + strength)).alias("host_purity"))
    purity = leaves.join(hosts, "host").withColumn(
        "purity", F.round((F.col("blk") + strength * F.col("host_purity")) / (F.col("lab") + strength), 9)).select(*above, "purity")
    shape = reduce(lambda a, b: F.when(b == "", a).otherwise(F.concat(a, F.lit("/"), b)), [F.col(t) for t in above[1:]], F.lit(""))
    judged = F.coalesce(F.col("ruled"), F.when(F.col("purity") > threshold, F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(purity, above, "left").select("page_id", "host", "path", "rule", judged.alias("verdict"), shape.alias("template"), "purity")
