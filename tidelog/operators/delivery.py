"""Delivery semantics on tables: commits, losses, dispatch, order, redelivery.

``polls`` is a log with ``poll_id`` and ``ok`` (whether processing the record succeeded).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.joins import bounded
from tidelog.functions.naming import strip_namespace

PARTITION = ["topic", "part"]
POLL = [*PARTITION, "poll_id"]


def alod_commits(polls: DataFrame, strict: bool = False) -> DataFrame:
    """Position committed after each poll under at-least-once delivery.

    It is the offset after the last successful record, even when earlier records of the
    poll failed; a poll without a success commits nothing. ``strict`` stops below the
    first failure instead, so that nothing failed is ever skipped.
    """
    last_ok = F.max(F.when(F.col("ok"), F.col("roff")))
    if strict:
        first_bad = F.min(F.when(~F.col("ok"), F.col("roff")))
        safe = F.max("roff") + 1
        commit = F.when(first_bad.isNull(), safe).when(first_bad > F.min("roff"), first_bad)
    else:
        commit = last_ok + 1
    return polls.groupBy(*POLL).agg(commit.alias("commit")).where(F.col("commit").isNotNull())


def amod_commits(polls: DataFrame) -> DataFrame:
    """Position committed for each poll under at-most-once delivery: all of the poll."""
    return polls.groupBy(*POLL).agg((F.max("roff") + 1).alias("commit"))


def final_positions(commits: DataFrame) -> DataFrame:
    """Where a group stands once all polls are committed."""
    return commits.groupBy(*PARTITION).agg(F.max("commit").alias("position"))


def lost_records(polls: DataFrame, partitions: int, delivery: str = "alod") -> DataFrame:
    """Failed records that nobody will read again, per partition.

    Nothing is retried. At most once: every failed record is lost. At least once: the
    failed ones below the final position are; those above come back after a restart.
    ``partitions`` is the number of (topic, part) pairs, which bounds the position table.
    """
    failed = polls.where(~F.col("ok")).select(*PARTITION, "roff")
    if delivery == "alod":
        # The last commit of all polls is the one after the partition's last success.
        last = polls.where("ok").groupBy(*PARTITION).agg((F.max("roff") + 1).alias("position"))
        failed = failed.join(bounded(last, partitions), PARTITION).where(F.col("roff") < F.col("position"))
    return failed.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("lost"))


def fetches(polls: DataFrame) -> DataFrame:
    """What one poll brought from one partition: record count and offset range."""
    return polls.groupBy(*POLL).agg(
        F.count(F.lit(1)).alias("num_records"),
        F.min("roff").alias("first_off"),
        F.max("roff").alias("last_off"),
    )


def dispatch(fetched: DataFrame, assignments: DataFrame) -> DataFrame:
    """Fetched partitions handed to their owners, matched by full topic and partition."""
    return fetched.join(assignments.select(*PARTITION, "client_id"), PARTITION)


def revoked_data_loss(
    fetched: DataFrame,
    assignments: DataFrame,
    ends: DataFrame,
    delivery: str = "amod",
    namespace: str = "",
) -> DataFrame:
    """Fetched partitions that no longer have an owner, with high watermark and size.

    A partition whose end is not known is reported with a null watermark.

    Only at-most-once delivery loses them; under at-least-once they are read again, so
    nothing is reported.
    """
    orphans = fetched.join(assignments.select(*PARTITION).distinct(), PARTITION, "left_anti")
    if delivery != "amod":
        orphans = orphans.where(F.lit(False))
    marks = ends.select(*PARTITION, F.col("end_off").alias("hwm"))
    return orphans.join(marks, PARTITION, "left").select(
        strip_namespace(F.col("topic"), namespace).alias("topic"),
        "part",
        "poll_id",
        "hwm",
        "num_records",
    )


def produced_vs_consumed(produced: DataFrame, consumed: DataFrame) -> DataFrame:
    """Totals of two runs side by side per partition; ``complete`` once consumed >= produced.

    Both inputs have ``topic, part, num_records`` and may have many rows per partition.
    """

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*PARTITION).agg(F.sum("num_records").alias(name))

    both = totals(produced, "produced").join(totals(consumed, "consumed"), PARTITION, "full")
    return (
        both.na.fill(0, ["produced", "consumed"])
        .withColumn("diff", F.col("produced") - F.col("consumed"))
        .withColumn("complete", F.col("consumed") >= F.col("produced"))
    )


def ordering_violations(
    log: DataFrame, seq: Column, within: list[str] | None = None, block: int = 1_000_000
) -> DataFrame:
    """Records whose sequence number is not the previous one plus one, in offset order.

    ``within`` names what has its own sequence, by default a partition. One window per
    sequence would put a hot one into one task, so the window runs over blocks of
    ``block`` offsets, and each block also gets the last record before it.
    """
    within = within or PARTITION
    rows = log.select(
        *within,
        "roff",
        seq.cast("bigint").alias("seq"),
        F.expr(f"roff div {int(block)}").alias("_block"),
        F.lit(False).alias("_carried"),
    )
    next_block = F.lead("_block").over(Window.partitionBy(*within).orderBy("_block"))
    carried = (
        rows.groupBy(*within, "_block")
        .agg(F.max("roff").alias("roff"), F.max_by("seq", "roff").alias("seq"))
        .withColumn("_block", next_block)
        .where(F.col("_block").isNotNull())
        .withColumn("_carried", F.lit(True))
    )
    in_order = Window.partitionBy(*within, "_block").orderBy("roff")
    return (
        rows.unionByName(carried)
        .withColumn("prev_seq", F.lag("seq").over(in_order))
        .where(~F.col("_carried") & (F.col("seq") != F.col("prev_seq") + 1))
        .select(*within, "roff", "seq", "prev_seq")
    )


def redelivery_dedup(delivered: DataFrame) -> DataFrame:
    """One copy of each record; at-least-once delivery may bring several."""
    return delivered.dropDuplicates([*PARTITION, "roff"])


def consume_rate(log: DataFrame, by: list[str]) -> DataFrame:
    """Records per second between the first and the last record."""
    elapsed = F.max("ts_us") - F.min("ts_us")
    return (
        log.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("num_records"), elapsed.alias("elapsed_us"))
        .withColumn(
            "per_second",
            F.when(
                F.col("elapsed_us") > 0,
                F.col("num_records") / (F.col("elapsed_us") / F.lit(1e6)),
            ),
        )
    )


def skip_empty(fetched: DataFrame) -> DataFrame:
    """Fetch results that brought records."""
    return fetched.where(F.col("num_records") > 0)
