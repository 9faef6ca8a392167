"""Reconciling wanted topics with the ones a cluster has.

Inputs: ``requests`` (``topic, want_parts``), ``catalog`` (``topic, parts, err``) and
``responses`` (``operation, topic, err``, operation one of create, grow, alter, delete).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.labels import UNKNOWN_TOPIC, admin_outcome
from tidelog.functions.naming import strip_namespace

# The setting that cannot be altered, and the wording of failures.
FROZEN_CONFIG = "cleanup.policy"
FAILURE_TEXT = {
    "create": "failed to create topic",
    "grow": "failed to update partitions for topic",
    "alter": "failed to alter configuration for topic",
    "delete": "failed to delete topic",
}


def list_topics(catalog: DataFrame, prefix: str = "") -> DataFrame:
    """Topics that start with a raw prefix, by name; ``err`` is set on unreadable ones."""
    return catalog.where(F.col("topic").startswith(prefix)).select("topic", "err").orderBy("topic")


def _present(catalog: DataFrame) -> DataFrame:
    """Catalogue rows of topics that exist; "unknown topic" means it does not."""
    return catalog.where(F.col("err").isNull() | (F.col("err") != UNKNOWN_TOPIC))


def missing_topics(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    return requests.select("topic").distinct().join(_present(catalog), "topic", "left_anti")


def topic_plan(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """What to do for each wanted topic: ``missing``, ``existing`` and ``grow`` flags.

    An existing topic grows when it has fewer partitions than wanted; -1 asks for the
    broker's default and so never grows.
    """
    have = _present(catalog).select("topic", F.col("parts").alias("have_parts"))
    planned = requests.distinct().join(have, "topic", "left")
    exists = F.col("have_parts").isNotNull()
    return planned.select(
        "topic",
        "want_parts",
        F.coalesce("have_parts", F.lit(0)).cast("bigint").alias("have_parts"),
        (~exists).alias("missing"),
        exists.alias("existing"),
        (exists & (F.col("have_parts") < F.col("want_parts"))).alias("grow"),
    )


def alterable_configs(plan: DataFrame, configs: dict[str, str]) -> DataFrame:
    """One row per existing topic and setting to alter."""
    wanted = [
        F.struct(F.lit(k).alias("name"), F.lit(v).alias("value"))
        for k, v in configs.items()
        if k != FROZEN_CONFIG
    ]
    entries = F.array(*wanted) if wanted else F.expr("cast(array() as array<struct<name:string,value:string>>)")
    return plan.where("existing").select("topic", F.inline(entries))


def admin_outcomes(responses: DataFrame) -> DataFrame:
    return responses.withColumn("outcome", admin_outcome(F.col("operation"), F.col("err")))


def _counted(responses: DataFrame, operation: str, namespace: str) -> DataFrame:
    """Equal responses are counted first, so labels are worked out once per kind."""
    kinds = (
        responses.where(F.col("operation") == operation)
        .groupBy("operation", "topic", "err")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        admin_outcomes(kinds)
        .where(F.col("outcome") != "ignored")
        .groupBy(strip_namespace(F.col("topic"), namespace).alias("topic"), "outcome")
        .agg(F.sum("_n").alias("value"))
    )


def topics_created(responses: DataFrame, namespace: str = "") -> DataFrame:
    """``topics.created.count`` by bare topic and outcome; "already exists" is not counted."""
    return _counted(responses, "create", namespace)


def topics_deleted(
    responses: DataFrame, namespace: str = "", topic_dim: DataFrame | None = None
) -> DataFrame:
    """``topics.deleted.count`` with topic attributes; "unknown topic" is not counted."""
    counted = _counted(responses, "delete", namespace)
    return counted if topic_dim is None else counted.join(topic_dim, "topic", "left")


def joined_errors(responses: DataFrame, namespace: str = "") -> DataFrame:
    """All failures of an operation as one text, a line per failing topic, in topic order.

    Equal responses are merged first, so a text has at most topics x error codes lines.
    """
    wording = F.lit(None).cast("string")
    for operation, text in FAILURE_TEXT.items():
        wording = F.when(F.col("operation") == operation, text).otherwise(wording)
    bare = strip_namespace(F.col("topic"), namespace)
    line = F.concat(wording, F.lit(' "'), bare, F.lit('": '), F.col("err"))
    kinds = responses.select("operation", "topic", "err").distinct()
    failed = admin_outcomes(kinds).where(F.col("outcome") == "failure")
    return (
        failed.select("operation", line.alias("line"))
        .groupBy("operation")
        .agg(
            F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("errors"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
