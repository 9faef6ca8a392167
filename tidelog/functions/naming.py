"""Namespaced topic names.

On the wire a topic is ``<namespace>-<topic>``, or just ``<topic>`` when there is no
namespace. Callers see the bare name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefix(namespace: str) -> str:
    """The literal prefix a namespace puts before every topic."""
    return f"{namespace}-" if namespace else ""


def add_namespace(topic: Column, namespace: str) -> Column:
    """Wire name of a bare topic."""
    return F.concat(F.lit(prefix(namespace)), topic) if namespace else topic


def strip_namespace(topic: Column, namespace: str) -> Column:
    """Bare name of a wire topic; a topic outside the namespace is returned as it is."""
    head = prefix(namespace)
    if not head:
        return topic
    return F.when(
        F.startswith(topic, F.lit(head)), F.substring(topic, len(head) + 1, 2**31 - 1)
    ).otherwise(topic)


def in_namespace(df: DataFrame, namespace: str, topic: str = "topic") -> DataFrame:
    """Keep the rows of one namespace.

    ``startswith`` on a plain column reaches a Parquet scan as ``StringStartsWith`` and
    prunes directories when the topic is a partition column.
    """
    head = prefix(namespace)
    return df.where(F.col(topic).startswith(head)) if head else df


def topic_regex(patterns: list[str], namespace: str, topic: Column) -> Column:
    """Unanchored match of any pattern.

    The prefix is glued to the pattern text before it is read as a regex, so in ``a|b``
    only the first branch carries the prefix.
    """
    head = prefix(namespace)
    matches = [topic.rlike(head + pattern) for pattern in patterns]
    result = matches[0]
    for match in matches[1:]:
        result = result | match
    return result
