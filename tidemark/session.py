"""Session settings and the shared folder jobs write their intermediate tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def builder(app_name: str = "tidemark", **settings: str) -> SparkSession.Builder:
    """A session builder with the settings the library assumes; keyword arguments use ``__`` for dots."""
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    for key, value in settings.items():
        b = b.config(key.replace("__", "."), value)
    return b


#: Bytes of stored files one task reads: some hundred MB of rows, which it can sort in memory beside its neighbours. Spark's own 128 MB
#: of Parquet become over a GB, which is sorted on disk.
READ_AT_ONCE = "16m"


def small_reads(spark: SparkSession) -> None:
    """Files are dealt to tasks in parts of ``READ_AT_ONCE``, unless the session has a setting of its own for that."""
    if spark.conf.get("spark.sql.files.maxPartitionBytes", None) is None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", READ_AT_ONCE)


def short_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the job that wrote them has ended, unless the session has a setting of its own for that.

    Spark's own way is to keep them until the driver collects the plan that they belong to, which leaves those of a whole run on disk.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, SETTINGS[name])


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session without that setting uses a folder of its warehouse, which it shares with nobody else.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody has used yet."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
