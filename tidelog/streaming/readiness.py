"""Readiness of a reader of compacted logs that outlives restarts.

A topic is *not started* until the reader has a position in it or it has been seen empty,
*not synced* while offsets below the high watermark remain, and *synced* from the first time
that none does: later records do not undo that. Observations are kept in a folder, a row for
each topic, and folded (see ``snapshots``), so a reader that restarts is as ready as it was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import compaction
from tidelog.streaming.snapshots import FOLD_EVERY, Updates

OBSERVED = "topic string, started boolean, synced boolean, remaining bigint"


def _latched(rows: DataFrame) -> DataFrame:
    """What was true once stays true; what remains is as of the last observation."""
    return rows.groupBy("topic").agg(
        F.bool_or("started").alias("started"),
        F.bool_or("synced").alias("synced"),
        F.max_by("remaining", "batch_id").alias("remaining"),
        F.max("batch_id").alias("batch_id"),
    )


@dataclass(frozen=True)
class Latch:
    folder: str
    fold_every: int = FOLD_EVERY

    @property
    def _table(self) -> Updates:
        return Updates(f"{self.folder}/observed", _latched, self.fold_every)

    def observe(self, ends: DataFrame, positions: DataFrame, batch_id: int) -> None:
        """Take note of where a reader stands after a batch.

        ``ends`` is ``topic, part, end_off`` at that time, ``positions`` is ``topic, part, position``.
        Noting a batch again replaces what was noted.
        """
        begun = positions.select("topic").distinct().withColumn("_begun", F.lit(True))
        progress = compaction.sync_progress(ends, positions).join(begun, "topic", "left")
        started = F.coalesce("_begun", F.lit(False)) | F.col("synced")
        rows = progress.select("topic", started.alias("started"), "synced", "remaining")
        self._table.store(rows, batch_id)

    def state(self, spark: SparkSession, topics: DataFrame) -> DataFrame:
        """``topic, started, synced, state`` of each ``topic`` in ``topics``."""
        known = self._table.read(spark, OBSERVED)
        rows = topics.select("topic").distinct().join(known, "topic", "left")
        return rows.select(
            "topic",
            F.coalesce("started", F.lit(False)).alias("started"),
            F.coalesce("synced", F.lit(False)).alias("synced"),
            compaction.readiness("started", "synced", "remaining").alias("state"),
        )
