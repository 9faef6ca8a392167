"""Substring dedup with difference-cover anchors.

A window of ``size`` consecutive words is removed from a text when the same words also start
in a text of a smaller id: each word covered by such a window goes. Windows are judged on
the input, not on what is left.

Windows are not all compared. ``COVER`` is a difference cover modulo ``PERIOD``: for any two
positions there is a shift below ``PERIOD`` that moves both onto the cover. So two equal
windows share an *anchor*, a run of ``size - PERIOD + 1`` words that begins at a cover
position in both texts. Three steps, each an exchange between blocks of texts and buckets of
hashes (see ``blocks``):

1. anchors at cover positions only, four bytes each: which of them do several texts hold?
2. *extend*: windows around shared anchors, by a 128-bit hash: which is the smallest id?
3. cover the words of windows that have a smaller id elsewhere, and cut them out.

A wrong match of short anchor hashes only costs a look at a window; windows are told apart
by 128 bits.

* Texts that are null or of fewer words than a window keep everything; null gives no words.
* Null ids are after all others: such a text loses what others have, and takes nothing.
* Rows of equal ids do not clean each other.
* Other columns are not carried; join on the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import blocks
from tidelog.llm.bytes_np import Words, buffers, chunks, combined, is_space, lean, mix, prefix_sums, range_hashes, text_array

PERIOD, COVER = 7, (0, 1, 3)
WINDOWS = "bucket int, block int, hashes binary, ids binary"
SMALLEST = "block int, bucket int, at binary, ids binary"
KEPT = "id bigint, n_words bigint, n_removed bigint, kept string"


class _Part:
    """A run of a block's texts: its words and the hashes of its anchors."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, first_row: int, size: int, n: int):
        self.raw, self.offsets, self.first_row = raw, offsets, first_row
        self.words = Words(raw, offsets, is_space())
        self.values = self.words.hashes(raw)
        length = size - PERIOD + 1
        at = self.words.whole(length)
        self.anchors = at[np.isin(self.words.number[at] % PERIOD, COVER)]
        sums = prefix_sums(self.values, 2)
        self.hashes = blocks.short(range_hashes(sums, self.anchors, self.anchors + length, 2), n)
        self.rows = self.words.row[self.anchors] + first_row


def _parts(texts: pa.Table, size: int, n: int) -> list[_Part]:
    raw, offsets = buffers(combined(texts["text"]))
    return [
        _Part(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a, size, n) for a, b in chunks(offsets)
    ]


def _anchors(parts: list[_Part]) -> tuple[np.ndarray, np.ndarray]:
    return blocks.held_often(
        np.concatenate([p.hashes for p in parts]), np.concatenate([p.rows for p in parts])
    )


def _candidates(parts: list[_Part], told: np.ndarray, size: int) -> list[np.ndarray]:
    """For each part the numbers of the words where windows with a shared anchor begin."""
    hashes, often = _anchors(parts)
    shared = np.union1d(hashes[often], told)
    out = []
    for p in parts:
        marks = p.anchors[blocks.member(p.hashes, shared)]
        steps = np.zeros(len(p.words) + 1, dtype=np.int32)
        np.add.at(steps, np.maximum(marks - (PERIOD - 1), 0), 1)
        np.add.at(steps, marks + 1, -1)
        near = np.cumsum(steps[:-1]) > 0
        whole = p.words.whole(size)
        out.append(whole[near[whole]])
    return out


class _Windows:
    """Candidate windows of a block: each occurrence, and the distinct ones in hash order."""

    def __init__(self, parts: list[_Part], told: np.ndarray, ids: np.ndarray, size: int):
        self.starts = _candidates(parts, told, size)
        high, low = [], []
        for p, at in zip(parts, self.starts, strict=True):
            high.append(range_hashes(prefix_sums(p.values, 3), at, at + size, 3))
            low.append(range_hashes(prefix_sums(mix(p.values ^ np.uint64(0x9E37)), 4), at, at + size, 4))
        high, low = np.concatenate(high), np.concatenate(low)
        self.ids = np.concatenate(
            [ids[p.words.row[at] + p.first_row] for p, at in zip(parts, self.starts, strict=True)]
        )
        order = np.lexsort((self.ids, low, high))
        high, low = high[order], low[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.number = np.empty(len(order), dtype=np.int64)
        self.number[order] = np.cumsum(fresh) - 1
        self.high, self.low, self.least = high[fresh], low[fresh], self.ids[order][fresh]


def _ids(texts: pa.Table) -> np.ndarray:
    return texts["id"].fill_null(int(blocks.NO_ID)).to_numpy()


def _block(texts: pa.Table) -> int:
    return texts["block"][0].as_py()


def dedup_substrings(df: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 13) -> DataFrame:
    """``id, n_words, n_removed, kept`` for each row: the words kept, joined by single spaces."""
    if size < PERIOD:
        raise ValueError(f"windows are of {PERIOD} words at least")
    n = blocks.pieces(df)
    texts = blocks.in_blocks(df, n, id_column, text)

    def send(block_texts: pa.Table) -> pa.Table:
        hashes, often = _anchors(_parts(block_texts, size, n))
        return blocks.send_hashes(_block(block_texts), hashes, often, n)

    def extend(block_texts: pa.Table, answers: pa.Table) -> pa.Table:
        found = _Windows(_parts(block_texts, size, n), blocks.told_shared(answers), _ids(block_texts), size)
        rows = []
        for bucket, s in blocks.each(blocks.bucket_of(found.high, n)):
            pair = np.stack([found.high[s], found.low[s]], axis=1)
            rows.append((bucket, _block(block_texts), pair.astype("<u8").tobytes(), found.least[s].astype("<i8").tobytes()))
        return blocks.frame(WINDOWS, rows)

    def cut(block_texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(block_texts):
            return _kept(block_texts, [], [])
        parts, ids = _parts(block_texts, size, n), _ids(block_texts)
        told = blocks.told_shared(blocks.of_kind(answers, 0).rename_columns({"a": "hashes"}))
        found = _Windows(parts, told, ids, size)
        begins = {b: s.start for b, s in blocks.each(blocks.bucket_of(found.high, n))}
        smaller = blocks.of_kind(answers, 1)
        for bucket, at, least in zip(*(smaller[c].to_pylist() for c in ("bucket", "a", "b")), strict=True):
            found.least[begins[bucket] + np.frombuffer(at, "<u4").astype(np.int64)] = np.frombuffer(least, "<i8")
        gone = found.least[found.number] < found.ids
        bounds = np.cumsum([0, *map(len, found.starts)])
        removed = [at[gone[a:b]] for at, a, b in zip(found.starts, bounds[:-1], bounds[1:], strict=True)]
        return _kept(block_texts, parts, removed, size)

    answers = blocks.shared_hashes(texts.groupBy("block").applyInArrow(lean(send), blocks.SENT))
    windows = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lean(_if_texts(extend, WINDOWS)), WINDOWS)
    smallest = windows.groupBy("bucket").applyInArrow(lean(_smallest), SMALLEST)
    both = blocks.answers_for(
        (answers, [F.col("hashes").alias("a"), F.lit(None).cast("binary").alias("b")]),
        (smallest, [F.col("at").alias("a"), F.col("ids").alias("b")]),
    )
    return texts.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(lean(cut), KEPT)


def _if_texts(step, schema: str):
    return lambda texts, answers: step(texts, answers) if len(texts) else blocks.frame(schema, [])


def _smallest(table: pa.Table) -> pa.Table:
    """For each block: its windows that a smaller id of another block has too, and that id."""
    bucket = table["bucket"][0].as_py() if len(table) else 0
    senders = table["block"].to_numpy()
    hashes = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in table["hashes"].to_pylist()]
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in table["ids"].to_pylist()])
    counts = [len(x) for x in hashes]
    both = np.concatenate(hashes)
    sender = np.repeat(np.arange(len(senders)), counts)
    place = np.arange(len(ids)) - np.repeat(np.cumsum([0, *counts[:-1]]), counts)
    order = np.lexsort((ids, both[:, 1], both[:, 0]))
    both = both[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (both[1:] != both[:-1]).any(axis=1)
    least = np.empty_like(ids)
    least[order] = ids[order][fresh][np.cumsum(fresh) - 1]
    told = np.flatnonzero(least < ids)
    return blocks.frame(
        SMALLEST,
        [
            (int(senders[k]), bucket, place[told[s]].astype("<u4").tobytes(), least[told[s]].astype("<i8").tobytes())
            for k, s in blocks.each(sender[told])
        ],
    )


def _kept(texts: pa.Table, parts: list[_Part], removed: list[np.ndarray], size: int = 0) -> pa.Table:
    """The rows of a block without the words that the removed windows cover."""
    counts, dropped, raw, ends = [], [], [], [np.zeros(1, dtype=np.int64)]
    for p, at in zip(parts, removed, strict=True):
        steps = np.zeros(len(p.words) + 1, dtype=np.int32)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + size, -1)
        gone = np.cumsum(steps[:-1]) > 0
        counts.append(np.diff(p.words.first))
        dropped.append(np.diff(np.concatenate(([0], np.cumsum(gone)))[p.words.first]))
        data, sizes = join_words(p.raw, p.offsets, p.words, ~gone)
        raw.append(data)
        ends.append(ends[-1][-1] + np.cumsum(sizes))
    join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.table(
        {
            "id": texts["id"],
            "n_words": pa.array(join(counts, np.int64), pa.int64()),
            "n_removed": pa.array(join(dropped, np.int64), pa.int64()),
            "kept": text_array(join(raw, np.uint8), np.concatenate(ends), pa.string()),
        }
    )


def join_words(
    raw: np.ndarray, offsets: np.ndarray, words: Words, keep: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text with one space between them, and each text's size.

    The byte after a word separates it from the next, so it can become the space.
    """
    number = np.flatnonzero(keep)
    steps = np.zeros(len(raw) + 1, dtype=np.int32)
    steps[words.start[number]] += 1
    steps[words.stop[number]] -= 1
    inside = np.cumsum(steps[:-1]) > 0
    more = number[:-1][words.row[number[:-1]] == words.row[number[1:]]]
    out = raw.copy()
    out[words.stop[more]] = 0x20
    inside[words.stop[more]] = True
    return out[inside], np.diff(np.concatenate(([0], np.cumsum(inside)))[offsets])
