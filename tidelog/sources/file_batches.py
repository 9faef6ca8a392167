"""Which files a micro-batch of a file stream takes, from the stream's own checkpoint.

Spark notes there, before a batch begins, up to which entry of each source's list of files it
goes. Entries of several batches may lie in one compacted list; each names its number.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "path string, timestamp bigint, batchId bigint"


def _ends(spark: SparkSession, checkpoint: str, batch_id: int) -> list[int]:
    """The last entry of each source that the batches up to this one take; -1 for none."""
    if batch_id < 0:
        return []
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/{batch_id}")
    # a few lines, read here: a job would cost more than all else that is done for a small batch
    opened = note.getFileSystem(spark._jsc.hadoopConfiguration()).open(note)
    try:
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8").splitlines()
    finally:
        opened.close()
    # a version, what the batch ran with, then a line for each source
    return [json.loads(line)["logOffset"] if line.startswith("{") else -1 for line in lines[2:]]


def files_of_batch(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """``path`` of each file of a micro-batch, as Spark writes it: a URI."""
    before = _ends(spark, checkpoint, batch_id - 1)
    found = None
    for source, last in enumerate(_ends(spark, checkpoint, batch_id)):
        first = (before[source] if source < len(before) else -1) + 1
        lists = []
        for n in range(first, last + 1):
            name = f"{checkpoint}/sources/{source}/{n}"
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            here = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
            lists.append(name if here else f"{name}.compact")
        if lists:
            entries = spark.read.schema(ENTRY).json(lists)
            paths = entries.where(F.col("batchId").between(first, last)).select("path")
            found = paths if found is None else found.unionAll(paths)
    return spark.createDataFrame([], "path string") if found is None else found
