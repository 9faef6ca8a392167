"""Folders that every executor can reach, and plans that are kept."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder of its own; on a cluster
    that would be lost with its machine, so it is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidelog-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def version_of(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """What changes when a table is written anew or rows are added to it: time, files and bytes of its path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(place)
    return fs.getFileStatus(place).getModificationTime(), size.getFileCount(), size.getLength()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/tidelog-{label}-{uuid.uuid4().hex}"


_MERGE_KEPT = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


@contextmanager
def merging_what_is_kept(spark: SparkSession):
    """Plans kept inside have small shuffle partitions merged, as those of any other query.

    Spark may leave a kept plan all its shuffle partitions, and then the smallest table has so many.
    """
    before = spark.conf.get(_MERGE_KEPT, None)
    spark.conf.set(_MERGE_KEPT, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_MERGE_KEPT)
        else:
            spark.conf.set(_MERGE_KEPT, before)
