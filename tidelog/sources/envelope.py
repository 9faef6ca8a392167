"""The record envelope, and its two shapes.

Wire shape (what Spark's Kafka source yields with ``includeHeaders``): ``topic,
partition, offset, key, value, timestamp, headers``. Log shape (what the operators here
take): ``topic, part, roff, rkey, rvalue, ts_us`` and, where present, ``headers``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import headers as hdr
from tidelog.functions.naming import add_namespace, strip_namespace
from tidelog.functions.routing import partition_for_key

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

WIRE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("headers", HEADERS),
    ]
)


def from_wire(df: DataFrame) -> DataFrame:
    """Wire shape to log shape; columns a source does not have are left out."""
    out = [
        F.col("topic"),
        F.col("partition").alias("part"),
        F.col("offset").alias("roff"),
        F.col("key").alias("rkey"),
        F.col("value").alias("rvalue"),
        F.unix_micros("timestamp").alias("ts_us"),
    ]
    return df.select(*out, *[c for c in ("headers",) if c in df.columns])


def to_record(df: DataFrame, namespace: str) -> DataFrame:
    """What user code sees of a log row: bare topic, partition, key and value."""
    return df.select(
        strip_namespace(F.col("topic"), namespace).alias("topic"), "part", "rkey", "rvalue"
    )


def to_envelope(
    records: DataFrame,
    namespace: str = "",
    partitions: int = 1,
    metadata: Column | None = None,
    partitioner: Column | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """Rows ready to be written: wire topic, partition, and the call's metadata as headers.

    ``records`` has ``topic, rkey, rvalue`` and may have more columns, which are kept.
    Every row gets the same metadata as headers, sorted by key. ``partitioner`` replaces
    routing by key; ``spread`` places rows that have no key.
    """
    default = partition_for_key(
        F.col("rkey"),
        spread if spread is not None else F.xxhash64("rvalue"),
        partitions,
    )
    part = default if partitioner is None else partitioner.cast("int")
    return (
        records.withColumn("part", part)
        .withColumn("topic", add_namespace(F.col("topic"), namespace))
        .withColumn("headers", hdr.map_to_headers(metadata if metadata is not None else F.expr(hdr.EMPTY)))
    )
