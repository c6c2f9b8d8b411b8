"""The landing zone: versions of each source, switched by a small manifest, and refreshed by key.

Below ``root/source`` lie ``data``, one folder a landing that is never written again, and ``manifest``, one small file a
landing that names the folders which make up that version. The manifest file is written last, so a landing that fails at any
point, or loses its driver, leaves the last good version as it was; readers that hold an older version keep it.

A refreshed source is cut into a fixed number of buckets by its key. A refresh writes the buckets that hold a new, changed or
gone key and names the untouched ones again, with the folders they already lie in.

One writer at a time per source; readers need no care. Folders no manifest names any more stay until their owner removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.operators import aggregates
from trialweave.operators.columns import quoted
from trialweave.operators.joins import read_bytes
from trialweave.session import stage

MANIFEST_SCHEMA = "version long, run string, landed timestamp, buckets int, bucket int, folder string, items long, columns string"
CHANGE_KINDS = ("new", "changed", "gone")
# Columns of the stored rows that readers do not see.
DIGEST, BUCKET = "__digest", "__bucket"
# Bytes of files a bucket of tables landed together stands for, and the least size that means Spark knows none.
BUCKET_BYTES, UNKNOWN_BYTES = 4 << 20, 1 << 60


class NothingLanded(ValueError):
    """The source has no finished landing, or not the one asked for."""


def manifest(spark: SparkSession, root: str, source: str) -> DataFrame:
    """One row per version and folder; empty where nothing has landed."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{source}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def versions(spark: SparkSession, root: str, source: str) -> DataFrame:
    """``version, landed, items``: the finished landings."""
    return manifest(spark, root, source).groupBy("version", "landed").agg(F.sum("items").alias("items"))


def entries(spark: SparkSession, root: str, source: str, version: int | None = None) -> list:
    """The folders of a version, the newest by default: one row per bucket, or one in all."""
    found = manifest(spark, root, source)
    if version is None:
        version = found.agg(F.max("version")).first()[0]
    rows = found.where(F.col("version") == version).collect() if version is not None else []
    last = max((r["run"] for r in rows), default=None)
    return [r for r in rows if r["run"] == last]


def _write_manifest(spark: SparkSession, root: str, source: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{source}/manifest")


def _new_run(spark: SparkSession, root: str, source: str) -> tuple[int, str, datetime]:
    last = manifest(spark, root, source).agg(F.max("version")).first()[0]
    now = datetime.now(timezone.utc)
    return (last or 0) + 1, f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:12]}", now


def inventory(spark: SparkSession, root: str, sources: Sequence[str]) -> DataFrame:
    """Records and last landing per source, from the manifests alone; a source without a landing has neither."""
    def one(source: str) -> DataFrame:
        newest = F.max(F.struct("version", "run"))
        found = manifest(spark, root, source)
        last = found.agg(newest.alias("last"))
        rows = found.join(F.broadcast(last), F.struct("version", "run") == F.col("last"))
        return rows.agg(F.lit(source).alias("source"), F.max("landed").alias("last_update"), F.sum("items").alias("total_records"))

    return reduce(DataFrame.unionByName, [one(s) for s in sources])


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows range-partitioned and sorted by the keys, so that few files and row groups hold any one of them."""
    return df.repartitionByRange(*[quoted(k) for k in keys]).sortWithinPartitions(*[quoted(k) for k in keys])


def bloom_options(keys: Sequence[str], distinct: int = 1_000_000) -> dict[str, str]:
    """Writer options for a Parquet bloom filter per key and row group."""
    out = {}
    for k in keys:
        out |= {f"parquet.bloom.filter.enabled#{k}": "true", f"parquet.bloom.filter.expected.ndv#{k}": str(distinct)}
    return out


def land(df: DataFrame, root: str, source: str, cluster_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> str:
    """Write one source's records as its next version; returns the version's folder.

    Rows are counted while they are written. With ``cluster_by`` they are laid out by these keys, with bloom filters on
    them, for point look-ups.
    """
    spark = df.sparkSession
    version, run, now = _new_run(spark, root, source)
    folder, watch = f"data/{run}", Observation(f"landing {run}")
    laid = clustered(df, cluster_by) if cluster_by else df
    settings = {**(bloom_options(cluster_by) if cluster_by else {}), **(options or {})}
    laid.observe(watch, F.count(F.lit(1)).alias("items")).write.options(**settings).parquet(f"{root}/{source}/{folder}")
    _write_manifest(spark, root, source, [(version, run, now, None, None, folder, watch.get["items"], df.schema.json())])
    return f"{root}/{source}/{folder}"


def land_together(tables: Mapping[str, DataFrame], key: str, folder: str, buckets: int = 64) -> dict[str, DataFrame]:
    """Land tables that are joined by one key as bucketed tables; returns them as read back, by name.

    ``buckets`` is the least number of buckets. Tables that read more than ``BUCKET_BYTES`` of files a bucket get more, so that the
    rows of all tables that meet in one task stay as many however large the tables are; a size that Spark does not know changes nothing.
    All are cut into the same number of buckets by the key and sorted within, so joins, aggregations and first rows by the key
    move none of them. They are entered in the session's catalog under names of their own, with their files below ``folder``.
    Tables without the key are landed as they are. One key's rows share a bucket: keys with a large share of all rows want the
    adaptive skew join on an unbucketed landing instead.
    """
    run, out = uuid.uuid4().hex, {}
    sizes = [read_bytes(df) for df in tables.values() if key in df.columns]
    buckets = max(buckets, -(-max((n for n in sizes if n < UNKNOWN_BYTES), default=0) // BUCKET_BYTES))
    for name, df in tables.items():
        table, path = f"landed_{name}_{run}", f"{folder}/{name}-{run}"
        if key in df.columns:
            laid = df.repartition(buckets, quoted(key)).write.bucketBy(buckets, key).sortBy(key)
        else:
            laid = df.write
        laid.format("parquet").option("path", path).saveAsTable(table)
        out[name] = df.sparkSession.table(table)
    return out


def _read(spark: SparkSession, root: str, source: str, rows: Sequence, schema: T.StructType) -> DataFrame:
    paths = [f"{root}/{source}/{r['folder']}" for r in rows]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_landed(spark: SparkSession, root: str, source: str, version: int | None = None) -> DataFrame:
    """A version of a source, the newest finished one by default."""
    rows = entries(spark, root, source, version)
    if not rows:
        raise NothingLanded(f"{source} has no landing" + (f" {version}" if version is not None else ""))
    # A version without rows has one entry without a folder.
    return _read(spark, root, source, [r for r in rows if r["folder"]], T.StructType.fromJson(json.loads(rows[0]["columns"])))


def _digest(df: DataFrame) -> Column:
    """A row's content: absent and null fields count alike, so a new column alone changes no row."""
    return F.md5(F.to_json(F.struct(*[quoted(c).alias(c) for c in sorted(df.columns)])))


def refresh(crawl: DataFrame, root: str, source: str, key: str, order: Sequence[Column], buckets: int = 64,
            whole: bool = False) -> int:
    """Merge a crawl into the newest version by key and land the result as the next one; returns its number.

    Of records with one key the first in ``order`` counts; records without a key are left out. Keys that the crawl lacks
    stay, or go with ``whole``. Columns are united, gaps are null. Only the buckets with a new, changed or gone key are read in full and
    written; to find them, keys and digests of the stored rows are read. What happened to which key is kept in the source's
    change log. The number of buckets is fixed by the first refresh.
    """
    spark = crawl.sparkSession
    now_landed = entries(spark, root, source)
    version, run, now = _new_run(spark, root, source)
    stored_in = now_landed[0]["buckets"] if now_landed else None
    buckets = stored_in or buckets
    schema = T.StructType.fromJson(json.loads(now_landed[0]["columns"])) if now_landed else crawl.schema
    united = T.StructType([*schema.fields, *[f for f in crawl.schema.fields if f.name not in schema.names]])
    folders = [r for r in now_landed if r["folder"]]
    bucket = F.pmod(F.xxhash64(quoted(key)), F.lit(buckets)).cast("int")

    newest = aggregates.dedup_keep_first(crawl.where(quoted(key).isNotNull()), [key], order)
    incoming = stage(newest.withColumns({DIGEST: _digest(crawl), BUCKET: bucket}), "crawl")

    def stored(rows: Sequence, *names: str) -> DataFrame:
        """Stored rows with digest and bucket, which an unbucketed landing does not hold yet."""
        if stored_in:
            fields = [*schema.fields, T.StructField(DIGEST, T.StringType())]
            df = _read(spark, root, source, rows, T.StructType(fields)).withColumn(BUCKET, bucket)
        else:
            df = _read(spark, root, source, rows, schema)
            df = df.where(quoted(key).isNotNull()).withColumns({DIGEST: _digest(df), BUCKET: bucket})
        return df.select(*names) if names else df

    old = stored(folders, key, DIGEST, BUCKET).select(quoted(key).alias("__key"), F.col(DIGEST).alias("__old"), F.col(BUCKET).alias("__at"))
    mine = incoming.select(key, DIGEST, BUCKET)
    met = mine.join(old, mine[key] == old["__key"], "full" if whole else "left")
    kind = (F.when(F.col("__old").isNull(), CHANGE_KINDS[0]).when(F.col(DIGEST).isNull(), CHANGE_KINDS[2])
            .when(F.col(DIGEST) != F.col("__old"), CHANGE_KINDS[1]))
    changes = stage(met.select(F.coalesce(quoted(key), F.col("__key")).alias(key), F.coalesce(F.col(BUCKET), F.col("__at")).alias(BUCKET),
                               kind.alias("kind")).where("kind IS NOT NULL"), "changes")
    # At most one row per bucket reaches the driver.
    touched = {r[0] for r in changes.select(BUCKET).distinct().collect()} if stored_in else set(range(buckets))

    kept = stored([r for r in folders if r["bucket"] is None or r["bucket"] in touched]).join(changes.select(key), key, "left_anti")
    fresh = incoming.join(changes.where(F.col("kind") != CHANGE_KINDS[2]).select(key), key, "left_semi")
    folder = f"data/{run}"
    written: dict[int, int] = {}
    if touched:
        merged = kept.unionByName(fresh, allowMissingColumns=True).select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in united.fields], DIGEST, BUCKET)
        merged.repartition(max(1, len(touched)), BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/{source}/{folder}")
        written = _bucket_counts(spark, f"{root}/{source}/{folder}")
    changes.select(F.lit(version).cast("long").alias("version"), F.lit(run).alias("run"), quoted(key).cast("string").alias("key"), "kind").write.mode(
        "append").parquet(f"{root}/{source}/changes")
    rows = [(version, run, now, buckets, b, f"{folder}/{BUCKET}={b}", n, united.json()) for b, n in sorted(written.items())]
    rows += [(version, run, now, buckets, r["bucket"], r["folder"], r["items"], united.json()) for r in folders if stored_in and r["bucket"] not in touched]
    _write_manifest(spark, root, source, rows or [(version, run, now, buckets, None, None, 0, united.json())])
    return version


def _bucket_counts(spark: SparkSession, path: str) -> dict[int, int]:
    """Rows per bucket of a folder just written; one row per bucket, none for a folder without rows."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return {}
    return {r[BUCKET]: r["n"] for r in found.groupBy(BUCKET).agg(F.count("*").alias("n")).collect()} if BUCKET in found.columns else {}


def change_log(spark: SparkSession, root: str, source: str) -> DataFrame:
    """``version, key, kind`` of all finished refreshes; kinds are new, changed and gone."""
    try:
        logged = spark.read.schema("version long, run string, key string, kind string").parquet(f"{root}/{source}/changes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logged = spark.createDataFrame([], "version long, run string, key string, kind string")
    finished = manifest(spark, root, source).select("run").distinct()
    return logged.join(finished, "run", "left_semi").select("version", "key", "kind")
