"""Consumer lag and assignment from commits, members and partition offsets.

Inputs (wire topic names):

* ``committed``: ``grp, topic, part, committed`` (-1 = none) and, optionally, ``commit_err``
* ``members``: ``grp, topic, part, client_id``
* ``offsets``: ``topic, part, start_off, end_off, start_err, end_err``
* ``monitor``: ``topic, regex, consumer`` (bare topic names)

All of them are as large as the metadata, not as the log. No join is hinted: small stored
metadata is broadcast by its statistics and large metadata is shuffled on its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.labels import lag_severity
from tidelog.functions.naming import in_namespace, strip_namespace

KEYS = ["grp", "topic", "part"]
# Error given to a committed or assigned partition that the log does not list.
MISSING_OFFSET = "MISSING_OFFSET"


def monitored_groups(monitor: DataFrame) -> DataFrame:
    """Every consumer group to ask about, once."""
    return monitor.select(F.col("consumer").alias("grp")).distinct()


def monitored(df: DataFrame, monitor: DataFrame) -> DataFrame:
    """Rows of ``df`` (``grp`` and bare ``topic``) that a monitor row selects.

    A monitor row without a regex selects by exact name; one with a regex selects only by
    it, unanchored, whatever its topic says. The group is the join key, the rest a residual
    condition.
    """
    t, m = df.alias("t"), monitor.alias("m")
    by_name = (F.col("m.regex") == "") & (F.col("m.topic") == F.col("t.topic"))
    by_regex = (F.col("m.regex") != "") & F.expr("t.topic rlike m.regex")
    return t.join(m, (F.col("t.grp") == F.col("m.consumer")) & (by_name | by_regex), "left_semi")


def monitored_topics(pairs: DataFrame, monitor: DataFrame) -> DataFrame:
    """The (grp, bare topic) pairs a monitor row selects, each once."""
    return monitored(pairs.select("grp", "topic").distinct(), monitor)


def lag_state(
    committed: DataFrame,
    members: DataFrame,
    offsets: DataFrame,
    monitor: DataFrame,
    namespace: str = "",
    failed_groups: DataFrame | None = None,
) -> DataFrame:
    """Lag of every partition of every monitored topic, with the error that spoils it.

    Columns: ``grp, topic`` (bare)``, part, client_id, committed, start_off, end_off, lag,
    err``. A group reports all partitions of each topic it has a commit or a member in. Lag
    is end - committed, without a commit end - start, and never negative. The error is that
    of the commit, else of the offsets.

    Commits, members and listed offsets are stacked and folded by key, so the only joins
    are the monitor filter and the expansion of topics to partitions.
    """

    def scoped(df: DataFrame) -> DataFrame:
        return in_namespace(df, namespace).withColumn(
            "topic", strip_namespace(F.col("topic"), namespace)
        )

    commit_err = F.col("commit_err") if "commit_err" in committed.columns else F.lit(None).cast("string")
    facts = committed.select(*KEYS, "committed", commit_err.alias("commit_err")).unionByName(
        members.select(*KEYS, "client_id"), allowMissingColumns=True
    )
    if failed_groups is not None:
        facts = facts.join(failed_groups.select("grp"), "grp", "left_anti")
    # The patterns are tried once for each group and topic, not for each partition.
    pairs = monitored_topics(scoped(facts), monitor)
    known = scoped(facts).join(pairs, ["grp", "topic"], "left_semi")
    measures = ["start_off", "end_off", "start_err", "end_err"]
    listed = (
        pairs.join(scoped(offsets.select("topic", "part", *measures)), "topic")
        .withColumn("_listed", F.lit(True))
    )
    state = (
        known.unionByName(listed, allowMissingColumns=True)
        .groupBy(*KEYS)
        .agg(*[F.max(c).alias(c) for c in ("committed", "commit_err", "client_id", *measures, "_listed")])
    )
    has_commit = F.coalesce(F.col("committed"), F.lit(-1)) >= 0
    lag = F.col("end_off") - F.when(has_commit, F.col("committed")).otherwise(F.col("start_off"))
    missing = F.when(F.col("_listed").isNull(), MISSING_OFFSET)
    return state.select(
        *KEYS,
        F.coalesce("client_id", F.lit("nil")).alias("client_id"),
        "committed",
        "start_off",
        "end_off",
        F.greatest(lag, F.lit(0)).cast("bigint").alias("lag"),
        F.coalesce(F.col("commit_err"), missing, F.col("start_err"), F.col("end_err")).alias("err"),
    )


def consumer_group_lag(state: DataFrame) -> DataFrame:
    """The reportable rows: any error drops the partition."""
    return state.where(F.col("err").isNull()).select(*KEYS, "client_id", "lag")


def lag_errors(state: DataFrame) -> DataFrame:
    """The dropped rows and how loudly to say so."""
    return state.where(F.col("err").isNotNull()).select(
        *KEYS, "err", lag_severity(F.col("err")).alias("severity")
    )


def consumer_group_assignment(state: DataFrame) -> DataFrame:
    """Reportable partitions per (group, topic, client); no member counts as ``nil``."""
    return (
        consumer_group_lag(state)
        .groupBy("grp", "topic", "client_id")
        .agg(F.count(F.lit(1)).alias("partitions"))
    )
