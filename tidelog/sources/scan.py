"""Reading a log: by topic, by pattern, in polls, from a commit, to the high watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.joins import bounded
from tidelog.functions.naming import add_namespace, topic_regex

DEFAULT_MAX_POLL = 500
PARTITION = ["topic", "part"]


def scan_topics(log: DataFrame, topics: list[str], namespace: str = "") -> DataFrame:
    """Records of the named topics (bare names)."""
    if not topics:
        raise ValueError("at least one topic must be set")
    names = [add_namespace(F.lit(t), namespace) for t in topics]
    return log.where(F.col("topic").isin(names))


def scan_topics_regex(log: DataFrame, patterns: list[str], namespace: str = "") -> DataFrame:
    """Records of topics that any pattern matches, unanchored."""
    if not patterns:
        raise ValueError("at least one topic must be set")
    return log.where(topic_regex(patterns, namespace, F.col("topic")))


def poll_id(offset: Column, max_poll: int = DEFAULT_MAX_POLL) -> Column:
    """Number of the poll a record comes in: at most ``max_poll`` records of a partition."""
    if max_poll < 1:
        raise ValueError("max poll records must be positive")
    return F.call_function("div", offset, F.lit(max_poll).cast("bigint"))


def with_polls(log: DataFrame, max_poll: int = DEFAULT_MAX_POLL) -> DataFrame:
    return log.withColumn("poll_id", poll_id(F.col("roff"), max_poll))


def replay(log: DataFrame, ends: DataFrame, topic: str) -> DataFrame:
    """A whole compacted topic from its start up to the high watermark in ``ends``.

    The topic is a full wire name: this reader adds no namespace. Each row carries
    ``hwm``. Records written after ``ends`` was taken are left for the next replay.
    """
    marks = ends.where(F.col("topic") == topic).select(*PARTITION, F.col("end_off").alias("hwm"))
    return (
        log.where(F.col("topic") == topic)
        .join(marks, PARTITION)
        .where(F.col("roff") < F.col("hwm"))
    )


def resume_marks(committed: DataFrame, partitions: DataFrame) -> DataFrame:
    """``grp, topic, part, committed``: where each group would go on, -1 being the start.

    ``committed`` has these columns. A group reads the topics that it has a row for; a partition
    of them that it has none for, as a new one, is read from its start.
    """
    topics = committed.select("grp", "topic").distinct()
    wanted = topics.join(partitions.select(*PARTITION).distinct(), "topic")
    return (
        wanted.join(committed.select("grp", *PARTITION, "committed"), ["grp", *PARTITION], "left")
        .withColumn("committed", F.coalesce("committed", F.lit(-1)))
    )


def from_commit(
    log: DataFrame, committed: DataFrame, ends: DataFrame | None = None, manifest: DataFrame | None = None
) -> DataFrame:
    """What each group would read after a restart: rows at or after its commit, in its topics.

    ``ends`` names the partitions there are. ``manifest`` (``topic, part, segment, first, next``) says which offsets a segment holds. With it
    ``log`` has the column ``segment`` too, and a group only gets the segments that end above its own
    commit in their partition; Spark opens no others. Without it the log is read from the least
    commit on, and asked for its partitions if ``ends`` is not given either.
    """
    if manifest is None:
        marks = resume_marks(committed, log if ends is None else ends)
        lowest = marks.agg(F.min("committed")).scalar()
        tail = log.where(F.col("roff") >= lowest)
        return tail.join(marks, PARTITION).where(F.col("roff") >= F.col("committed"))
    marks = resume_marks(committed, manifest if ends is None else ends)
    segments = manifest.join(marks, PARTITION).where(F.col("next") > F.col("committed"))
    segments = segments.select("grp", *PARTITION, "segment", "committed")
    # Numbers of segments are as many as the cuts of the log. As a filter they prune folders.
    known = segments.agg(F.count(F.lit(1)).alias("rows"), F.collect_set("segment").alias("numbers")).first()
    some = log.where(F.col("segment").isin(known["numbers"]))
    found = some.join(bounded(segments, known["rows"]), [*PARTITION, "segment"])
    return found.where(F.col("roff") >= F.col("committed")).drop("segment")


def group_counts(log: DataFrame, groups: list[str]) -> DataFrame:
    """Records each group sees per partition: every group sees all of them.

    Rows are counted before they are repeated per group.
    """
    return (
        log.groupBy(*PARTITION)
        .agg(F.count(F.lit(1)).alias("num_records"))
        .withColumn("grp", F.explode(F.array(*[F.lit(g) for g in groups])))
        .select("grp", *PARTITION, "num_records")
    )
