"""Vectorised work on the bytes of many texts at once (numpy, inside tasks).

Texts of an Arrow column lie end to end in one buffer. Words, word hashes and hashes of
word or byte windows are found for all of them with whole-array operations.

Hashes are sums of per-byte random numbers times powers of an odd constant, modulo 2**64,
so the hash of any range is a difference of two prefix sums; ``mix`` then spreads the bits.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes looked at in one go; bounds the temporary arrays (about 60 bytes for each).
CHUNK = 1 << 21


def _odd(seed: int) -> int:
    value = int(np.random.default_rng(seed).integers(0, 1 << 62))
    return (value << 2 | 3) & (1 << 64) - 1


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=U64)


BYTE_VALUES = _table(11)
_powers: dict = {}


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the seed's constant and of its inverse."""
    have = _powers.get(seed)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        base = _odd(seed)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, b, dtype=U64)
            out[0] = 1
            both.append(np.multiply.accumulate(out))
        have = _powers[seed] = tuple(both)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def prefix_sums(values: np.ndarray, seed: int) -> np.ndarray:
    """Sums so far of values times powers, with a zero in front."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(seed, len(values))[0][: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of ranges, equal for equal contents wherever they lie."""
    inverse = powers(seed, len(sums))[1]
    return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(U64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offsets of its rows; nulls are empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def combined(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """One array with 64-bit offsets, so that any number of bytes fits."""
    wide = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    column = column.cast(wide)
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else (
        pa.array([], wide) if isinstance(column, pa.ChunkedArray) else column
    )


def chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes; a longer row is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 * CHUNK) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` has at most ``most`` bytes in each, or one row.

    What a task holds besides the batch it was given stays small; memory that is no longer
    used goes back, since workers live on.
    """
    for batch in batches:
        _, offsets = buffers(batch.column(column))
        for a, b in chunks(offsets, most):
            yield batch.slice(a, b - a)
        give_back()


def give_back() -> None:
    """Return unused memory to the system: workers live on between tasks, beside the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(step: Callable) -> Callable:
    """``step`` over one or two Arrow tables, giving its memory back when it is done."""

    def one(table: pa.Table) -> pa.Table:
        try:
            return step(table)
        finally:
            give_back()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return step(left, right)
        finally:
            give_back()

    return one if step.__code__.co_argcount == 1 else two


def is_space() -> np.ndarray:
    """Which bytes separate words: space and the control characters 9 to 13."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def lowered() -> np.ndarray:
    """Byte values with A-Z as a-z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


class Words:
    """The words of a run of texts, as arrays.

    ``start``/``stop`` are byte ranges, ``row`` the text each word is in, ``first`` the
    number of the first word of each text (with the total at the end).
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        rows = len(offsets) - 1
        inside = ~separators[raw]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        begin[heads] = inside[heads]
        end[tails] = inside[tails]
        self.start = np.flatnonzero(begin)
        self.stop = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(rows), np.diff(self.first))
        self.number = np.arange(len(self.start)) - self.first[self.row]

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, raw: np.ndarray, seed: int = 1) -> np.ndarray:
        return range_hashes(prefix_sums(BYTE_VALUES[raw], seed), self.start, self.stop, seed)

    def whole(self, size: int) -> np.ndarray:
        """Numbers of the words at which ``size`` words of the same text begin."""
        at = np.arange(len(self))
        return at[at + size <= self.first[self.row + 1]]


def text_array(raw: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow column out of bytes and row offsets."""
    wide = pa.large_string() if pa.types.is_string(kind) else pa.large_binary()
    out = pa.Array.from_buffers(
        wide,
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(raw))],
    )
    return out.cast(kind) if offsets[-1] < 1 << 31 else out
