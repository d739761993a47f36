"""Spark session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}

_to_remove: set[str] = set()


def build_session(app_name: str = "tillmark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def settings_for(input_bytes: int, cores: int, shuffled_share: float = 0.5) -> dict[str, str]:
    """Session settings sized for a job: up to 512 MB of shuffled data per task, at least two
    tasks per core, and input splits of 16 MB to 1 GB. Scans stream, so large splits cost no
    memory, and they keep the number of shuffle blocks (scan tasks times shuffle partitions)
    in bounds. Adaptive execution merges partitions that turn out small."""
    mb = 1024 * 1024
    tasks = max(2 * cores, int(input_bytes * shuffled_share / (512 * mb)) + 1)
    split = min(1024 * mb, max(16 * mb, input_bytes // (2 * cores)))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: named by ``spark.checkpoint.dir``, set on the context, or
    else the warehouse, which executors share too. The same rule holds for every master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; one parent folder per Spark application, removed at its end."""
    parent = _steps_folder(spark)
    if parent not in _to_remove:
        _to_remove.add(parent)
        atexit.register(remove_steps, spark)
    return f"{parent}/{label}-{uuid.uuid4().hex}"


def _steps_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tillmark-{spark.sparkContext.applicationId}"


def remove_steps(spark: SparkSession) -> None:
    """Delete the written steps of this application, while its session still runs: at the end of a job, and
    when Python ends. Frames made from them cannot be read after that."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(_steps_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute when executors are lost, keeps column
    pruning, and counts from file footers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
