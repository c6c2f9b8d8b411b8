"""Sharding by fixed virtual slots.

A record hashes into one of some thousands of virtual slots, for good. A versioned map
says which shard owns which slot. Only the map is edited when shards are added or sizes
drift: the number of slots bounds it, so it may pass the driver and be broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.common import numbered_columns
from trialweave.session import stage

SLOTS = 4096
ROW_OVERHEAD = 16


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and a fixed overhead; a null text has the overhead only."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def virtual_slot(key: Column, check: Column, slots: int = SLOTS) -> Column:
    """The slot of a record; null keys are spread by the check value."""
    return F.pmod(F.xxhash64(key, check), F.lit(slots)).cast("int")


def slot_sizes(rows: DataFrame, slot: str, size: str) -> dict[int, int]:
    """Bytes per slot: at most one row per slot reaches the driver."""
    sums = rows.groupBy(slot).agg(F.sum(size).alias("bytes"))
    return {r[slot]: r["bytes"] for r in sums.collect()}


def new_map(sizes: Mapping[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Every slot gets a shard: the largest slot first, always to the shard with the fewest bytes."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    heap = [(0, 0, shard) for shard in range(shards)]
    owner = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, held, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), held + 1, shard))
    return owner


def edited_map(owner: Mapping[int, int], sizes: Mapping[int, int], shards: int, tolerance: float = 0.02) -> dict[int, int]:
    """The next version of a map: slots move from the fullest to the emptiest shard until both are near the mean.

    Slots of shards that no longer exist move first. A slot moves only if that narrows the gap.
    """
    owner = dict(owner)
    load = dict.fromkeys(range(shards), 0)
    held: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    homeless = []
    for slot, shard in sorted(owner.items()):
        if shard in load:
            load[shard] += sizes.get(slot, 0)
            held[shard].append(slot)
        else:
            homeless.append(slot)

    def give(slot: int, shard: int) -> None:
        owner[slot] = shard
        held[shard].append(slot)
        load[shard] += sizes.get(slot, 0)

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        give(slot, min(load, key=lambda s: (load[s], s)))
    mean = sum(load.values()) / shards
    while True:
        full = max(load, key=lambda s: (load[s], -s))
        empty = min(load, key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        if gap <= tolerance * mean:
            return owner
        movable = [s for s in held[full] if 0 < sizes.get(s, 0) < gap]
        if not movable:
            return owner
        slot = min(movable, key=lambda s: (abs(sizes[s] - gap / 2), s))
        held[full].remove(slot)
        load[full] -= sizes[slot]
        give(slot, empty)


def write_map(spark: SparkSession, folder: str, version: int, owner: Mapping[int, int]) -> None:
    """Store a version of the map; older versions stay readable."""
    rows = spark.createDataFrame(sorted(owner.items()), "virtual_slot int, shard int").coalesce(1)
    rows.write.parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> dict[int, int]:
    rows = spark.read.schema("virtual_slot int, shard int").parquet(f"{folder}/version={version}")
    return {r["virtual_slot"]: r["shard"] for r in rows.collect()}


def map_frame(spark: SparkSession, owner: Mapping[int, int]) -> DataFrame:
    """One row per slot, small by construction, hence broadcast."""
    return F.broadcast(spark.createDataFrame(sorted(owner.items()), "__slot int, __shard int"))


def with_shards(df: DataFrame, owner: Mapping[int, int], slots: int = SLOTS, key: str = "doc_id", text: str = "text",
                out: str = "shard") -> DataFrame:
    """Add the shard to whole rows; no shuffle. A column named ``out`` is replaced; other columns stay, whatever their names."""
    plain, name = numbered_columns(df)
    placed = plain.withColumn("__slot", virtual_slot(F.col(name[key]), F.crc32(F.col(name[text])), slots))
    joined = placed.join(map_frame(df.sparkSession, owner), "__slot", "left")
    shard = F.col("__shard").alias(out)
    kept = [shard if c == out else F.col(name[c]).alias(c) for c in df.columns]
    return joined.select(*kept, *([] if out in df.columns else [shard]))


def measured_map(df: DataFrame, shards: int, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> dict[int, int]:
    """Aggregate the bytes per slot of a table and place its slots."""
    rows = df.select(virtual_slot(F.col(key), F.crc32(F.col(text)), slots).alias("s"), row_bytes(F.col(text)).alias("b"))
    return new_map(slot_sizes(rows, "s", "b"), shards, slots)


def shard_layout(df: DataFrame, shards: int, slots: int = SLOTS, key: str = "doc_id", text: str = "text",
                 map_folder: str | None = None) -> DataFrame:
    """One row per record: its size, shard and gapless place in the shard.

    Law ``bytes``: slots are dealt by their bytes, so shards differ by less than a small slot unless a single
    slot exceeds a shard's share. Rows that agree in key and text share a slot, whatever their number. A null
    key is a key like any other, spread by its text; a null text has only the overhead and a null checksum; an
    empty table gives no rows. Other columns are not looked at, whatever their names. With ``map_folder`` the
    map is stored there as version 1.

    Places are counted per (slot, input partition) and put one after another, so no task sees a whole slot or
    shard. The texts are read once and never shuffled.
    """
    spark = df.sparkSession
    rows = stage(df.select(
        F.col(key).alias("doc_id"), row_bytes(F.col(text)).alias("size"), F.crc32(F.col(text)).alias("text_crc32"),
        virtual_slot(F.col(key), F.crc32(F.col(text)), slots).alias("virtual_slot"),
        F.spark_partition_id().alias("part")), "shard-rows")
    owner = new_map(slot_sizes(rows, "virtual_slot", "size"), shards, slots)
    if map_folder:
        write_map(spark, map_folder, 1, owner)
    placed = rows.join(map_frame(spark, owner), F.col("virtual_slot") == F.col("__slot"))
    counts = placed.groupBy(F.col("__shard").alias("s"), F.col("virtual_slot").alias("v"), F.col("part").alias("p")).agg(
        F.count("*").alias("n"))
    # Starts in two steps, slot by slot and then shard by shard, the second over at most one row per slot.
    before = Window.partitionBy("v").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    in_slot = counts.withColumn("in_slot", F.coalesce(F.sum("n").over(before), F.lit(0)))
    slots_before = Window.partitionBy("s").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = counts.groupBy("s", "v").agg(F.sum("n").alias("n")).select(
        "v", F.coalesce(F.sum("n").over(slots_before), F.lit(0)).alias("in_shard"))
    starts = in_slot.join(in_shard, "v").select("v", "p", (F.col("in_slot") + F.col("in_shard")).alias("start"))
    place = F.row_number().over(Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    return placed.withColumn("place", place).join(starts, (F.col("virtual_slot") == F.col("v")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("__shard").alias("shard"),
        (F.col("start") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
