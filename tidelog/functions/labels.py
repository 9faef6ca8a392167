"""Codes and errors as labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compression codec ids in order from 0.
CODECS = ("none", "gzip", "snappy", "lz4", "zstd")

# Error codes of the log's administration protocol.
TOPIC_EXISTS = "TOPIC_ALREADY_EXISTS"
INVALID_REQUEST = "INVALID_REQUEST"
UNKNOWN_TOPIC = "UNKNOWN_TOPIC_OR_PARTITION"

# How a client's own failures are spelled in an ``err`` column.
DEADLINE = "deadline_exceeded"
CANCELED = "canceled"

# The error each administrative operation takes as "nothing to do".
IGNORED = {"create": TOPIC_EXISTS, "grow": INVALID_REQUEST, "delete": UNKNOWN_TOPIC}


def codec_label(codec: Column) -> Column:
    """Name of a compression codec id; ids outside the table are ``unknown``."""
    names = F.array(*[F.lit(name) for name in CODECS])
    return F.when(codec.between(0, len(CODECS) - 1), F.get(names, codec)).otherwise(
        F.lit("unknown")
    )


def produce_error_reason(err: Column, is_broker_error: Column) -> Column:
    """Why a record was not produced; a broker error keeps its own message."""
    return (
        F.when(err == DEADLINE, "timeout")
        .when(err == CANCELED, "canceled")
        .when(is_broker_error, err)
        .otherwise("unknown")
    )


def connect_error_reason(err: Column) -> Column:
    """Why a connection attempt failed; broker messages are not looked at here."""
    return F.when(err == CANCELED, "canceled").when(err == DEADLINE, "timeout").otherwise("unknown")


def outcome(err: Column) -> Column:
    return F.when(err.isNull(), "success").otherwise("failure")


def admin_outcome(operation: Column, err: Column) -> Column:
    """``success``, ``ignored`` or ``failure`` for one administrative response."""
    ignored = F.lit(False)
    for name, code in IGNORED.items():
        ignored = ignored | ((operation == name) & (err == code))
    return F.when(err.isNull(), "success").when(ignored, "ignored").otherwise("failure")


def lag_severity(err: Column) -> Column:
    """Log level of a partition left out of the lag report."""
    return F.when(err == UNKNOWN_TOPIC, "debug").otherwise("warn")
