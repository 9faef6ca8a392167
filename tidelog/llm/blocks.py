"""Texts in blocks, hashes in buckets: the exchange that several operators share.

A *block* is a stable piece of the input, held by one task at a time with its texts. A
*bucket* is a range of a hash. Each block sends every bucket the distinct hashes it has
there, packed into one binary value; the bucket finds out what it wants to know about a hash
over all blocks, and answers each block that asked.

A hash that a third of all texts hold is sent once by each block, so buckets stay even. Both
ways go through ordinary Spark shuffles, and Spark computes the shuffle of the texts by
block once for all the steps that read it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.bytes_np import lean
from tidelog.llm.common import block_of, partitions

#: Largest id: stands in for a null one, which is after all others.
NO_ID = np.int64((1 << 63) - 1)
_LOW = np.uint64((1 << 32) - 1)


def pieces(df: DataFrame) -> int:
    """How many blocks, and buckets: as many as shuffle partitions.

    Each block may write to each bucket, so there are up to the square of this of messages;
    with partitions of 100 MB or more a message is still hundreds of bytes.
    """
    return partitions(df.sparkSession)


def in_blocks(df: DataFrame, n: int, id_column: str, text: str) -> DataFrame:
    """``block, id, text``."""
    return df.select(
        block_of(n, F.col(id_column), F.xxhash64(text)).alias("block"),
        F.col(id_column).cast("bigint").alias("id"),
        F.col(text).alias("text"),
    )


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Buckets by the top 24 bits, so that sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)


def short(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket and low 32 bits of a hash: what is left of it when four bytes are sent to a bucket.

    Sorted hashes need not have sorted short forms.
    """
    return bucket_of(hashes, n) << np.uint64(32) | hashes & _LOW


def packed(values: np.ndarray) -> bytes:
    """The low four bytes of each value."""
    return values.astype("<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4").astype(np.uint64)


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array, and its length at the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


def each(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of a sorted array: value and where it is."""
    at = runs(keys)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield int(keys[a]), slice(a, b)


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def frame(schema: str, rows: list[tuple]) -> pa.Table:
    """An Arrow table of ``name type`` columns out of rows."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table(
        {name: pa.array(column, kinds[kind]) for (name, kind), column in zip(fields, columns, strict=True)}
    )


# Which hashes do other blocks hold too?

SENT = "bucket int, block int, once binary, often binary"
ANSWERED = "block int, bucket int, hashes binary"


def send_hashes(block: int, hashes: np.ndarray, often: np.ndarray, n: int) -> pa.Table:
    """Distinct short hashes of a block; ``often``: those that several of its texts hold."""
    order = np.argsort(hashes, kind="stable")
    hashes, often = hashes[order], often[order]
    rows = []
    for bucket, at in each(hashes >> np.uint64(32)):
        own, many = hashes[at] & _LOW, often[at]
        rows.append((bucket, block, packed(own[~many]), packed(own[many])))
    return frame(SENT, rows)


def answer_shared(table: pa.Table) -> pa.Table:
    """For each block: its hashes that it holds once and others hold too."""
    bucket = table["bucket"][0].as_py() if len(table) else 0
    once = [unpacked(x) for x in table["once"].to_pylist()]
    often = [unpacked(x) for x in table["often"].to_pylist()]
    blocks = table["block"].to_numpy()
    values = np.concatenate([*once, *often])
    senders = np.repeat(np.concatenate([blocks, np.full(len(often), -1)]), [len(x) for x in (*once, *often)])
    order = np.argsort(values, kind="stable")
    values, senders = values[order], senders[order]
    at = runs(values)
    several = np.repeat((np.diff(at) > 1) | (np.minimum.reduceat(senders, at[:-1]) < 0 if len(values) else np.zeros(0, bool)), np.diff(at))
    told = several & (senders >= 0)
    values, senders = values[told], senders[told]
    order = np.argsort(senders, kind="stable")
    values, senders = values[order], senders[order]
    return frame(ANSWERED, [(block, bucket, packed(values[s])) for block, s in each(senders)])


def shared_hashes(sent: DataFrame) -> DataFrame:
    return sent.groupBy("bucket").applyInArrow(lean(answer_shared), ANSWERED)


def told_shared(answers: pa.Table, column: str = "hashes") -> np.ndarray:
    """Sorted short hashes that a block was told of."""
    parts = [
        np.uint64(bucket) << np.uint64(32) | unpacked(hashes)
        for bucket, hashes in zip(answers["bucket"].to_pylist(), answers[column].to_pylist(), strict=True)
    ]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def held_often(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes (sorted), and which of them several rows hold."""
    order = np.argsort(hashes, kind="stable")
    hashes, rows = hashes[order], rows[order]
    at = runs(hashes)[:-1]
    if not len(at):
        return hashes, np.zeros(0, dtype=bool)
    return hashes[at], np.minimum.reduceat(rows, at) != np.maximum.reduceat(rows, at)


def answers_for(*kinds: tuple[DataFrame, list[Column]]) -> DataFrame:
    """Answers of several kinds in one frame ``block, kind, bucket, a, b``."""
    out = None
    for kind, (df, columns) in enumerate(kinds):
        one = df.select("block", F.lit(kind).alias("kind"), "bucket", *columns)
        out = one if out is None else out.unionAll(one)
    return out


def of_kind(answers: pa.Table, kind: int) -> pa.Table:
    return answers.filter(pa.array(answers["kind"].to_numpy() == kind))
