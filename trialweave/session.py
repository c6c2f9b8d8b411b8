"""Session settings and shared-folder staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime options the library's plans rely on; all are public Spark settings.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled bytes are packed: a task's hash tables and sort buffers take some ten to sixty times as much, so its share is kept small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Tables landed in sorted buckets, one file each, are not sorted again; every sort holds a page of memory in its task.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # The JVM never compiles methods beyond 8000 bytes of code, so a generated loop over
    # many wide columns would run interpreted; below the limit Spark splits it up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "trialweave", master: str | None = None, **options: str) -> SparkSession:
    """A session with the library's options; ``options`` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_OPTIONS, "spark.sql.session.timeZone": "UTC", **options}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to a session somebody else built."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for cut lineage.

    Only a local session without the setting gets a temporary folder: on a cluster
    executors do not share one, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="trialweave-")
    context.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/trialweave/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Runs the plan once, cuts its lineage and survives the loss of executors; unlike a
    checkpoint the Parquet copy still prunes columns and pushes filters down.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
