"""Byte-level BPE encoding and decoding with the ranks of a local file.

``encode`` adds the token ids of each text, ``decode`` the bytes of each list of ids. Both
run in Arrow batches, without a shuffle: a row's tokens depend on that row alone.

Texts are cut at *safe boundaries* before they go to the library, so that a very long text
costs no more memory than a piece: a single space between two characters that are not white
space always begins a new match of the pre-splitting pattern, because every match that holds
other characters ends before a space and takes a space only at its front. Ids of the pieces
one after the other are therefore the ids of the whole.

Null texts have no ids (as empty ones), null lists decode to no bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.bytes_np import slices

#: A text longer than this many characters is encoded in pieces of about this size.
PIECE = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids out of a rank file: a base64 token and a number in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def encoding(path: str, pattern: str):
    """The encoder of a rank file, which each worker reads from its own installation."""
    import tiktoken

    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut a text at safe boundaries, each at or after ``size`` characters from the last."""
    start = 0
    while len(text) - start > size:
        at = start + size
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                at = -1
                break
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def encode(
    df: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    to: str = "ids",
    size: int = PIECE,
    decoded: str | None = None,
) -> DataFrame:
    """``df`` with the token ids of ``text`` in the column ``to``, replacing one of that name.

    Ids are packed as in a token file: little-endian unsigned 32-bit integers, one after the
    other, in a binary value; ``unpacked`` gives them as an array. With ``decoded`` the bytes
    that the ids stand for come in a column of that name, out of the same pass.
    """

    def both(value: str | None, own) -> list[bytes]:
        ids = b"".join(
            own.encode_to_numpy(piece, allowed_special=set(), disallowed_special=()).astype("<u4").tobytes()
            for piece in pieces(value or "", size)
        )
        return [ids, _bytes_of(ids, own)] if decoded else [ids]

    return _with_binary(df, text, [to, decoded] if decoded else [to], ranks, pattern, both)


def decode(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the packed ``ids`` stand for in the binary column ``to``.

    The bytes are what the tokens hold, whether or not they are valid UTF-8.
    """
    return _with_binary(df, ids, [to], ranks, pattern, lambda value, own: [_bytes_of(value or b"", own)])


def _bytes_of(ids: bytes, own) -> bytes:
    return own.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())


def token_count(ids: str = "ids") -> Column:
    return F.expr(f"octet_length({ids}) div 4")


def unpacked(df: DataFrame, ids: str = "ids", to: str = "id_array") -> DataFrame:
    """``df`` with packed ``ids`` as ``array<int>`` in the column ``to``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ids):
            values = [np.frombuffer(v.as_py() or b"", dtype="<i4") for v in batch.column(ids)]
            yield _with_column(batch, to, pa.array(values, pa.list_(pa.int32())))

    return df.mapInArrow(run, _with_field(df, to, T.ArrayType(T.IntegerType())))


def _with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], [*names, name])


def _with_binary(df: DataFrame, source: str, to: list[str], ranks: str, pattern: str, values) -> DataFrame:
    """``df`` with binary columns ``to``, which ``values(value, encoding)`` lists for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(ranks, pattern)
        for batch in slices(batches, source):
            rows = [values(value.as_py(), own) for value in batch.column(source)]
            for k, name in enumerate(to):
                batch = _with_column(batch, name, pa.array([row[k] for row in rows], pa.binary()))
            yield batch

    fields = [f for f in df.schema.fields if f.name not in to] + [T.StructField(n, T.BinaryType()) for n in to]
    return df.mapInArrow(run, T.StructType(fields))
