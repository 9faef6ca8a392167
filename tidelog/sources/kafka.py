"""Options for Spark's own Kafka source and sink.

The connector is a separate jar. Where it is absent these functions can only be checked
as dictionaries; loading the format then fails in Spark itself.
"""

from __future__ import annotations

import json


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidelog.functions.naming import prefix, topic_regex
from tidelog.sources.envelope import from_wire
from tidelog.sources.log_table import choose_codec


def source_options(
    brokers: str,
    topics: list[str],
    namespace: str = "",
    regex: bool = False,
    max_per_trigger: int = 5_000_000,
    group_prefix: str | None = None,
) -> dict[str, str]:
    """Reader options; a group with no progress yet starts at the earliest offset.

    ``max_per_trigger`` bounds a micro-batch over all its partitions, and with it what one
    partition can bring to one task.

    ``subscribePattern`` must match a whole name, so patterns are wrapped; ``read_stream``
    filters again with the unanchored rule.
    """
    if not topics:
        raise ValueError("at least one topic must be set")
    head = prefix(namespace)
    options = {
        "kafka.bootstrap.servers": brokers,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": str(max_per_trigger),
    }
    if regex:
        options["subscribePattern"] = "|".join(f".*(?:{head + t}).*" for t in topics)
    else:
        options["subscribe"] = ",".join(head + t for t in topics)
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return options


def starting_offsets(ends: DataFrame, positions: DataFrame) -> str:
    """``startingOffsets`` that resumes a group: its position in each partition, or the start.

    ``ends`` lists the partitions; the text has one number for each of them.
    """
    known = ends.select("topic", "part").join(positions, ["topic", "part"], "left")
    # Fixed value: -2 is the connector's code for the earliest offset.
    rows = known.select("topic", "part", F.coalesce("position", F.lit(-2)).alias("at")).collect()
    offsets: dict[str, dict[str, int]] = {}
    for row in rows:
        offsets.setdefault(row["topic"], {})[str(row["part"])] = row["at"]
    return json.dumps(offsets, sort_keys=True)


def replay_options(brokers: str, topic: str) -> dict[str, str]:
    """Batch options for a compacted topic, start to current end; no namespace is added."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        "includeHeaders": "true",
    }


def sink_options(brokers: str, codecs: list[str] | str = ()) -> dict[str, str]:
    """Writer options; the connector takes one codec, the first of the list."""
    return {
        "kafka.bootstrap.servers": brokers,
        "includeHeaders": "true",
        "kafka.compression.type": choose_codec(codecs),
    }


def read_stream(
    spark: SparkSession, brokers: str, topics: list[str], namespace: str = "", regex: bool = False, **more
) -> DataFrame:
    """Live records in log shape."""
    options = source_options(brokers, topics, namespace, regex, **more)
    rows = spark.readStream.format("kafka").options(**options).load()
    if regex:
        rows = rows.where(topic_regex(topics, namespace, F.col("topic")))
    return from_wire(rows)


def sink_rows(envelope: DataFrame, own_partitioner: bool = False) -> DataFrame:
    """Rows for the sink. Unless the caller routed them, the client's partitioner does."""
    routed = [F.col("part").alias("partition")] if own_partitioner else []
    return envelope.select(
        "topic",
        *routed,
        F.col("rkey").cast("binary").alias("key"),
        F.col("rvalue").cast("binary").alias("value"),
        "headers",
    )


def produce(
    envelope: DataFrame, brokers: str, codecs: list[str] | str = (), own_partitioner: bool = False
) -> None:
    """Synchronous write: returns when all records are stored, raises if any is not."""
    rows = sink_rows(envelope, own_partitioner)
    rows.write.format("kafka").options(**sink_options(brokers, codecs)).save()


def produce_stream(
    envelope: DataFrame,
    brokers: str,
    checkpoint: str,
    codecs: list[str] | str = (),
    own_partitioner: bool = False,
) -> DataStreamWriter:
    """Asynchronous write as a stream; call ``start()`` on what is returned."""
    rows = sink_rows(envelope, own_partitioner)
    return (
        rows.writeStream.format("kafka")
        .options(**sink_options(brokers, codecs))
        .option("checkpointLocation", checkpoint)
    )


