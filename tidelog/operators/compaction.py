"""Compacted logs: the newest value of each key, and whether a reader has caught up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(log: DataFrame, drop_null_values: bool = False) -> DataFrame:
    """``topic, rkey, rvalue, roff`` of the newest record of each key.

    A key lives in one partition, so offsets order its records. A task keeps one row per
    key before the shuffle, so a hot key costs one row per task. A null value is a value
    like any other unless it is asked to delete its key.
    """
    # the key comes first: topics share a prefix, which makes them slow to sort by
    newest = log.groupBy("rkey", "topic").agg(
        F.max_by(F.struct("rvalue", "roff"), "roff").alias("_newest")
    )
    rows = newest.select("topic", "rkey", "_newest.rvalue", "_newest.roff")
    return rows.where(F.col("rvalue").isNotNull()) if drop_null_values else rows


def sync_progress(ends: DataFrame, positions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How far a reader is from the high watermark, per topic.

    ``ends`` is ``topic, part, end_off``; ``positions`` is ``topic, part, position`` (the
    next offset to read) and any columns named in ``by``. All partitions of a topic count,
    also those the reader has not begun; a topic with nothing to read is synced.
    """
    by = by or []
    if by:
        readers = positions.select(*by, "topic").distinct()
        wanted = readers.join(ends.select("topic", "part", "end_off"), "topic")
    else:
        wanted = ends.select("topic", "part", "end_off")
    left = F.greatest(
        F.col("end_off") - F.greatest(F.coalesce("position", F.lit(0)), F.lit(0)), F.lit(0)
    )
    return (
        wanted.join(positions.select(*by, "topic", "part", "position"), [*by, "topic", "part"], "left")
        .groupBy(*by, "topic")
        .agg(F.sum(left).cast("bigint").alias("remaining"))
        .withColumn("synced", F.col("remaining") == 0)
    )


def readiness(started: str, synced: str, remaining: str) -> Column:
    """Readiness as text: ``not started``, ``not synced`` with what remains, or ``synced``."""
    left = F.concat(F.lit("not synced: "), F.col(remaining).cast("string"), F.lit(" remaining"))
    return F.when(F.col(synced), "synced").when(F.col(started), left).otherwise("not started")


def sync_state(progress: DataFrame) -> DataFrame:
    """Readiness of readers that have started, from one look at their progress."""
    return progress.withColumn("_started", F.lit(True)).select(
        *progress.columns, readiness("_started", "synced", "remaining").alias("state")
    )


def readiness_history(observations: DataFrame, at: str, by: list[str] | None = None) -> DataFrame:
    """What a reader's readiness was at each of several times, by a latch.

    ``observations`` has ``topic``, ``at`` and ``remaining``, null where the reader had not started.
    A reader (``by``) stays synced with a topic once nothing remained of it, whatever came later.
    """
    so_far = Window.partitionBy(*(by or []), "topic").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return (
        observations.withColumn("started", F.bool_or(F.col("remaining").isNotNull()).over(so_far))
        .withColumn("synced", F.coalesce(F.bool_or(F.col("remaining") == 0).over(so_far), F.lit(False)))
        .withColumn("state", readiness("started", "synced", "remaining"))
    )
