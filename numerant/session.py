"""Session helpers shared by jobs, queries and tests."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "numerant") -> SparkSession:
    """The active session, or a new one. Cluster settings given to spark-submit are kept."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost more than the plans of many-column stages
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local session that names none (a laptop, a test) gets a temporary folder; on a cluster that
    would be a different disk for each executor, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="numerant-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, among those of this application."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/numerant/{spark.sparkContext.applicationId}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on whatever file system it is on; False if there was none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has written below the shared folder. Frames read from there end with it."""
    remove_path(spark, _scratch(spark))


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan in at least as many partitions as there are cores.

    A small file of one row group is one task, whatever is computed from it. A table large enough
    to fill the cores comes back as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


@contextlib.contextmanager
def cached(df: DataFrame, enabled: bool = True) -> Iterator[DataFrame]:
    """Keep ``df`` for the passes inside the block; lost blocks are recomputed from lineage."""
    if not enabled or df.storageLevel != StorageLevel.NONE:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
