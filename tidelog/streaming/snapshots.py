"""Tables that a stream updates batch by batch, read from a snapshot and the batches since.

``<path>/batch_id=N`` holds what micro-batch N added or changed. After every so many batches
they are *folded* with the last snapshot into ``<path>-folded/upto=N``, one row for each key.
An empty file ``<path>-folded/current/N`` then says that this snapshot is whole: a file is
there or is not, so readers see the old snapshot or the new one, never a part of one. They
open the newest snapshot and the batches after it, however many there have been.

A fold that dies leaves no such file; the next one writes the snapshot again, and until then
readers open the older snapshot and more batches. A batch that is written again after a crash
has the same rows, so a snapshot that already holds it stays right. Nothing is deleted but by
``remove_folded``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Batches between two folds.
FOLD_EVERY = 50


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers at the end of the names in a folder."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


@dataclass(frozen=True)
class Updates:
    """``fold`` makes one row for each key out of rows of several batches, told apart by
    ``batch_id``, and must give the same whether it is applied at once or in steps."""

    path: str
    fold: Callable[[DataFrame], DataFrame]
    every: int = FOLD_EVERY

    def store(self, batch: DataFrame, batch_id: int, mode: str = "overwrite") -> None:
        """Write what a micro-batch changed, and fold if it is time to."""
        batch.write.mode(mode).parquet(f"{self.path}/batch_id={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self.fold_up_to(batch.sparkSession, batch.schema, batch_id)

    def folded(self, spark: SparkSession) -> int:
        """The last batch that the newest snapshot holds, or -1."""
        return max(_numbers(spark, f"{self.path}-folded/current", ""), default=-1)

    def last(self, spark: SparkSession) -> int:
        """The last batch that was written whole, or -1. A batch in the making does not count."""
        written = _numbers(spark, self.path, "batch_id=")
        for n in reversed(written):
            fs, done = _file_system(spark, f"{self.path}/batch_id={n}/_SUCCESS")
            if fs.exists(done):
                return n
        return self.folded(spark)

    def fold_up_to(self, spark: SparkSession, schema: T.StructType | str, batch_id: int) -> None:
        """Make a snapshot of everything up to a batch, if there is none yet."""
        last = self.folded(spark)
        if last >= batch_id:
            return
        rows = self._rows(spark, schema, last, batch_id)
        self.fold(rows).select(*rows.columns).write.mode("overwrite").parquet(f"{self.path}-folded/upto={batch_id}")
        fs, whole = _file_system(spark, f"{self.path}-folded/current/{batch_id}")
        fs.create(whole, True).close()

    def read(self, spark: SparkSession, schema: T.StructType | str, upto: int | None = None) -> DataFrame:
        """One row for each key, as of the last batch. ``schema`` is that of a batch.

        ``upto`` leaves out later batches that are not folded yet, as one that is half written.
        """
        rows = self._rows(spark, schema, self.folded(spark), upto)
        return self.fold(rows).select(*[c for c in rows.columns if c != "batch_id"])

    def remove_folded(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete snapshots but the newest ``keep``, and the batches that the oldest of these holds.

        Readers that began before an older snapshot was replaced may still need it.
        """
        whole = _numbers(spark, f"{self.path}-folded/current", "")
        kept = whole[-keep:]
        if not kept:
            return
        names = [f"{self.path}/batch_id={n}" for n in _numbers(spark, self.path, "batch_id=") if n <= kept[0]]
        for n in _numbers(spark, f"{self.path}-folded", "upto="):
            if n < kept[0]:
                names += [f"{self.path}-folded/current/{n}", f"{self.path}-folded/upto={n}"]
        for name in names:
            fs, folder = _file_system(spark, name)
            fs.delete(folder, True)

    def _rows(self, spark: SparkSession, schema: T.StructType | str, after: int, upto: int | None) -> DataFrame:
        """The snapshot of batch ``after`` and the batches from there on (to ``upto``)."""
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        columns = T.StructType([f for f in fields.fields if f.name != "batch_id"] + [T.StructField("batch_id", T.LongType())])
        batches = [n for n in _numbers(spark, self.path, "batch_id=") if n > after and (upto is None or n <= upto)]
        # An empty table beside the others would be a task for each core.
        if after < 0 and not batches:
            return spark.createDataFrame([], columns)
        rows = None
        if batches:
            reader = spark.read.schema(columns).option("basePath", self.path)
            rows = reader.parquet(*[f"{self.path}/batch_id={n}" for n in batches])
        if after >= 0:
            folded = spark.read.schema(columns).parquet(f"{self.path}-folded/upto={after}")
            rows = folded if rows is None else folded.unionByName(rows)
        return rows
