"""Suffix-array dedup: repeated byte strings found by longest previous factors.

A text is its UTF-8 bytes. A position is repeated when the ``size`` bytes from there also
start elsewhere, in the same text or another; the bytes that such strings cover, overlaps
included, are removed. With ``keep="none"`` all copies go, with ``keep="first"`` a string
goes only where it started before, in the order of (id, position), so the first copy stays.
Strings are judged on the input and never cross texts.

No task sorts the suffixes of everything. Each start position of a string picks two *anchors*:
the leftmost least hashes of 64 bytes in the first and the second half of the string. Equal
strings pick equal anchors at equal distances, so a string whose anchors do not both occur
elsewhere is not repeated. Starts whose lesser anchor is the same form a *fragment*, the
bytes from the first of them to the end of the last one's string; equal strings meet in the
bucket of that anchor's hash, and every start is in one fragment at most. Steps (see
``blocks`` for the exchange):

1. anchor hashes, four bytes each: which occur more than once, and which have very many
   different strings around them?
2. fragments of those anchors, each distinct one sent once by a block, go to their bucket.
   There the suffixes of distinct fragments are put in order (prefix doubling, as far as
   ``size`` bytes), neighbours get their common prefix, and for each suffix the previous and
   the next one in suffix order that starts at a smaller position give its longest previous
   factor (at a larger position: its longest later one);
3. the positions found go back to their blocks, which cut.

A fragment that occurs more than once is repeated as a whole, so copies cost a text once a
block and no sorting.

Equal strings lie at equal distances from their anchor, so a fragment can be cut at fixed
distances. The strings of such a *piece* have all but a few bytes in common, its *core*, and
equal strings have equal cores. Fragments around a crowded anchor (a passage that very many
texts hold, each with edits of its own) are cut by their blocks and meet in the buckets of their
cores' hashes, as if these were anchors. What still meets in a large group is cut in the bucket,
ever shorter, until at most ``SORTED`` bytes are sorted in one go.

* Null texts count as empty; texts shorter than ``size`` keep everything.
* Null ids are after all others; rows of equal ids are different texts.
* Other columns are not carried; join on the id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import blocks
from tidelog.llm.bytes_np import BYTE_VALUES, U64, buffers, chunks, combined, lean, mix, prefix_sums, range_hashes, text_array

ANCHOR = 64
#: Bytes hashed in one go, and bytes of fragments sorted in one go.
PIECE, SORTED = 1 << 19, 1 << 19
#: Start positions in a piece of a fragment, where its anchor has too many.
SLICE = 32
#: Different surroundings of an anchor, over all blocks, from which it is crowded. It is so if one
#: block has its share of them, two at least.
CROWD = 4096
ANCHORS = "bucket int, block int, once binary, often binary, crowded binary"
ANSWERED = "block int, bucket int, hashes binary, crowded binary"
SENT = "bucket int, block int, hashes binary, anchors binary, ids binary, starts binary, offsets binary, many binary, sizes binary, texts binary"
FOUND = "block int, bucket int, at binary, ranges binary"
KEPT = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, from running minima of rows of that width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class _Runs:
    """The start positions of a block, in runs that pick the same two anchors.

    Of each run: first and last start, the hashes and places of the least anchors of the
    strings' first and second half, the lesser of them, which is the string's anchor, and a
    hash of its bytes.
    """

    def __init__(self, texts: pa.Table, size: int):
        self.raw, self.offsets = buffers(combined(texts["text"]))
        found = [self._piece(a, b, size) for a, b in self._pieces()]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 7
        self.first, self.last, self.left, self.right, left_hash, right_hash, self.content = columns
        self.left_hash, self.right_hash = left_hash.astype(U64), right_hash.astype(U64)
        lesser = self.left_hash >> U64(32) <= self.right_hash >> U64(32)
        # Anchors are picked for small hashes; mixed once more they spread over all buckets.
        self.left_hash, self.right_hash = mix(self.left_hash), mix(self.right_hash)
        self.pick = np.where(lesser, self.left, self.right)
        self.anchor = np.where(lesser, self.left_hash, self.right_hash)

    def _pieces(self):
        """Ranges of start positions: whole texts up to ``PIECE`` bytes, longer texts in parts."""
        a, end = 0, int(self.offsets[-1])
        while a < end:
            b = min(a + PIECE, end)
            whole = int(self.offsets[np.searchsorted(self.offsets, b, side="right") - 1])
            b = whole if whole > a else b
            yield a, b
            a = b

    def _piece(self, a: int, b: int, size: int):
        row = np.searchsorted(self.offsets, b - 1, side="right") - 1
        raw = self.raw[a : min(b + size - 1, int(self.offsets[row + 1]))]
        at = np.arange(max(0, len(raw) - ANCHOR + 1))
        sums = prefix_sums(BYTE_VALUES[raw], 1)
        hashes = range_hashes(sums, at, at + ANCHOR, 1)
        width = size - ANCHOR + 1
        half = width // 2
        least = sliding_least(hashes >> U64(32) << U64(32) | at.astype(U64), width - half)
        ends = np.minimum(self.offsets[1:] - a, len(raw))
        ends = ends[(self.offsets[:-1] < a + len(raw)) & (self.offsets[1:] > a)]
        begins = np.concatenate(([0], ends[:-1]))
        steps = np.zeros(len(raw) + 2, dtype=np.int32)
        some = ends - begins >= size
        np.add.at(steps, begins[some], 1)
        np.add.at(steps, ends[some] - size + 1, -1)
        starts = np.flatnonzero(np.cumsum(steps) > 0)
        starts = starts[starts < b - a]
        place = lambda x: (x & U64(0xFFFFFFFF)).astype(np.int64)
        left, right = place(least[starts]), place(least[starts + half])
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (starts[1:] != starts[:-1] + 1)
        heads = np.flatnonzero(fresh)
        tails = np.concatenate((heads[1:], [len(starts)])) - 1 if len(heads) else heads
        left, right, first, last = left[heads], right[heads], starts[heads], starts[tails]
        content = range_hashes(sums, first, last + size, 1)
        # Hashes go as signed numbers, so that all columns have one type.
        signed = [x.view(np.int64) for x in (hashes[left], hashes[right], content)]
        return first + a, last + a, left + a, right + a, *signed

    def anchors(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct short hashes of all anchors, and which of them lie at several places."""
        near = blocks.short(np.concatenate((self.left_hash, self.right_hash)), n)
        return blocks.held_often(near, np.concatenate((self.left, self.right)))

    def crowded(self, n: int) -> np.ndarray:
        """Short hashes, sorted, of the anchors of strings with a block's share of ``CROWD`` different runs."""
        near = blocks.short(self.anchor, n)
        order = np.lexsort((self.content, near))
        near, content = near[order], self.content[order]
        fresh = np.ones(len(near), dtype=bool)
        fresh[1:] = (near[1:] != near[:-1]) | (content[1:] != content[:-1])
        near = near[fresh]
        at = blocks.runs(near)
        return near[at[:-1]][np.diff(at) >= max(2, CROWD // n)]


def _send_anchors(block: int, own: _Runs, n: int) -> pa.Table:
    sent = blocks.send_hashes(block, *own.anchors(n), n)
    crowded = own.crowded(n)
    among = {bucket: blocks.packed(crowded[s]) for bucket, s in blocks.each(crowded >> U64(32))}
    return sent.append_column("crowded", pa.array([among.get(b, b"") for b in sent["bucket"].to_pylist()], pa.binary()))


def _answer_anchors(table: pa.Table) -> pa.Table:
    """As ``blocks.answer_shared``, and for each block those of its anchors that are crowded in any."""
    told = blocks.answer_shared(table)
    told = told.append_column("crowded", pa.array([b""] * len(told), pa.binary()))
    crowded = np.unique(np.concatenate([blocks.unpacked(x) for x in table["crowded"].to_pylist()]))
    rows = []
    if len(crowded):
        for bucket, block, *held in zip(*(table[c].to_pylist() for c in ("bucket", "block", "once", "often")), strict=True):
            own = np.concatenate([blocks.unpacked(x) for x in held])
            own = own[blocks.member(own, crowded)]
            if len(own):
                rows.append((block, bucket, b"", blocks.packed(own)))
    return pa.concat_tables([told, blocks.frame(ANSWERED, rows)])


def _digests(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit hashes of ranges of bytes, as rows of two numbers."""
    digests = b"".join(
        hashlib.blake2b(raw[a:b].data, digest_size=16).digest() for a, b in zip(begin.tolist(), end.tolist(), strict=True)
    )
    return np.frombuffer(digests, "<u8").reshape(-1, 2)


def _pieces(first: np.ndarray, last: np.ndarray, pick: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Fragments cut at multiples of ``width`` from their picks.

    Of each piece: its fragment, first and last start, and where the bytes begin that all strings
    at its distances have in common; they are ``width`` - 1 less than a string's.
    """
    low = (first - pick) // width
    count = (last - pick) // width - low + 1
    which = np.repeat(np.arange(len(first)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    begin = pick[which] + (low[which] + at) * width
    return which, np.maximum(first[which], begin), np.minimum(last[which], begin + width - 1), begin + width - 1


class _Fragments:
    """Fragments of a block: runs of starts whose anchors both occur elsewhere, joined where
    the string's anchor is the same. Those of ``crowded`` anchors are in pieces, with their
    cores for anchors. ``head`` has the first copy of each distinct one, in the order they are
    sent, ``number`` the distinct one of each, ``many`` those with copies."""

    def __init__(self, own: _Runs, told: np.ndarray, crowded: np.ndarray, ids: np.ndarray, size: int, n: int):
        hashes, often = own.anchors(n)
        shared = np.union1d(hashes[often], told)
        both = blocks.member(blocks.short(own.left_hash, n), shared) & blocks.member(blocks.short(own.right_hash, n), shared)
        at = np.flatnonzero(both)
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (own.pick[at[1:]] != own.pick[at[:-1]]) | (own.first[at[1:]] != own.last[at[:-1]] + 1)
        heads = np.flatnonzero(fresh)
        tails = np.concatenate((heads[1:], [len(at)])) - 1 if len(heads) else heads
        self.first, self.last = own.first[at[heads]], own.last[at[tails]]
        self.anchors, pick = own.anchor[at[heads]], own.pick[at[heads]]
        cut = blocks.member(blocks.short(self.anchors, n), crowded)
        if cut.any():
            _, first, last, core = _pieces(self.first[cut], self.last[cut], pick[cut], SLICE)
            cores = _digests(own.raw, core, core + size - SLICE + 1)[:, 0]
            whole = (self.first, self.last, self.anchors, pick)
            pieces = (first, last, cores, core)
            self.first, self.last, self.anchors, pick = (np.concatenate((x[~cut], y)) for x, y in zip(whole, pieces, strict=True))
        self.picks = pick - self.first
        self.row = np.searchsorted(own.offsets, self.first, side="right") - 1
        self.starts = self.first - own.offsets[self.row]
        self.hashes = _digests(own.raw, self.first, self.last + size)
        bucket = blocks.bucket_of(self.anchors, n)
        order = np.lexsort((self.starts, self.row, ids[self.row], self.hashes[:, 1], self.hashes[:, 0], bucket))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (self.hashes[order][1:] != self.hashes[order][:-1]).any(axis=1)
        heads = np.flatnonzero(fresh)
        self.number = np.empty(len(order), dtype=np.int64)
        self.number[order] = np.cumsum(fresh) - 1
        self.head = order[heads]
        self.many = np.diff(np.concatenate((heads, [len(order)]))) > 1
        self.bucket = bucket[self.head]


def suffix_order(text: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the given starts and the common prefixes of neighbours, both up to ``size`` bytes.

    Ranks of 8, 16, 32, ... bytes by prefix doubling; at least ``size`` bytes follow each
    start. Equal suffixes are in order of position. The first common prefix is 0.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(size + 8, dtype=np.uint8)))
    values = np.zeros(n, dtype=U64)
    for k in range(8):
        values |= padded[k : n + k].astype(U64) << U64(56 - 8 * k)
    levels, width = [], 8
    while True:
        rank = np.unique(values, return_inverse=True)[1].astype(np.uint32)
        levels.append((width, rank))
        if width * 2 > size:
            break
        values = rank.astype(U64) << U64(32)
        values[: n - width] |= rank[width:]
        width *= 2
    rest = size - width  # the last step overlaps, to end at ``size`` bytes exactly
    whole = levels[-1][1][starts].astype(U64) << U64(32) | levels[-1][1][starts + rest]
    order = starts[np.lexsort((starts, whole))]
    common = np.zeros(len(order), dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    length = np.zeros(len(a), dtype=np.int64)
    for width, rank in reversed(levels):
        for _ in range(2 if width == levels[-1][0] else 1):
            same = (length + width <= size) & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
            length[same] += width
            a[same] += width
            b[same] += width
    for _ in range(7):
        same = (length < size) & (padded[a] == padded[b])
        length[same] += 1
        a[same] += 1
        b[same] += 1
    common[1:] = length
    return order, common


def longest_factors(order: np.ndarray, common: np.ndarray, later: bool = False) -> np.ndarray:
    """For each suffix in ``order``: its longest common prefix with any suffix at a smaller position.

    That is the nearest one before or the nearest one after it in suffix order whose position
    is smaller (``later``: larger). Nearest smaller positions are found for all at once: who
    points at a larger position goes on to where that one points, and the common prefix is
    the least on the way.
    """
    position = -order if later else order
    backward = _nearest(position, common)
    forward = _nearest(position[::-1], np.concatenate(([0], common[1:][::-1])) if len(common) else common)[::-1]
    return np.maximum(backward, forward)


def _nearest(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    n = len(position)
    point = np.arange(-1, n - 1)
    length = common.copy()
    todo = np.flatnonzero(point >= 0)
    todo = todo[position[point[todo]] > position[todo]]
    while len(todo):
        via = point[todo]
        length[todo] = np.minimum(length[todo], length[via])
        point[todo] = point[via]
        todo = todo[point[todo] >= 0]
        todo = todo[position[point[todo]] > position[todo]]
    length[point < 0] = 0
    return length


def dedup_suffixes(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 400, keep: str = "none"
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` (bytes) for each row."""
    if size < 2 * ANCHOR or keep not in ("none", "first"):
        raise ValueError(f"size is {2 * ANCHOR} at least, keep is none or first")
    n = blocks.pieces(df)
    texts = blocks.in_blocks(df, n, id_column, text)

    def send(block_texts: pa.Table) -> pa.Table:
        return _send_anchors(block_texts["block"][0].as_py(), _Runs(block_texts, size), n)

    def fragments(block_texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(block_texts):
            return blocks.frame(SENT, [])
        own, ids = _Runs(block_texts, size), _ids(block_texts)
        found = _Fragments(own, blocks.told_shared(answers), blocks.told_shared(answers, "crowded"), ids, size, n)
        rows = []
        for bucket, s in blocks.each(found.bucket):
            at = found.head[s]
            spans = zip(found.first[at].tolist(), (found.last[at] + size).tolist(), strict=True)
            rows.append(
                (
                    bucket,
                    block_texts["block"][0].as_py(),
                    found.hashes[at].astype("<u8").tobytes(),
                    found.anchors[at].astype("<u8").tobytes(),
                    ids[found.row[at]].astype("<i8").tobytes(),
                    found.starts[at].astype("<i8").tobytes(),
                    found.picks[at].astype("<u4").tobytes(),
                    found.many[s].astype(np.uint8).tobytes(),
                    (found.last[at] + size - found.first[at]).astype("<u4").tobytes(),
                    b"".join(own.raw[a:b].tobytes() for a, b in spans),
                )
            )
        return blocks.frame(SENT, rows)

    def find(table: pa.Table) -> pa.Table:
        return _repeated(table, size, keep)

    def cut(block_texts: pa.Table, answers: pa.Table) -> pa.Table:
        own, ids = _Runs(block_texts, size), _ids(block_texts)
        told = blocks.of_kind(answers, 0)
        found = _Fragments(own, blocks.told_shared(told, "a"), blocks.told_shared(told, "b"), ids, size, n)
        whole = found.many[found.number].copy()
        if keep == "first":
            whole[found.head] = False
        begin, end = [found.first[whole]], [found.last[whole] + size]
        begins = {b: s.start for b, s in blocks.each(found.bucket)}
        repeated = blocks.of_kind(answers, 1)
        for bucket, numbers, ranges in zip(*(repeated[c].to_pylist() for c in ("bucket", "a", "b")), strict=True):
            head = found.head[begins[bucket] + np.frombuffer(numbers, "<u4").astype(np.int64)]
            pair = np.frombuffer(ranges, "<u4").reshape(-1, 2).astype(np.int64)
            begin.append(found.first[head] + pair[:, 0])
            end.append(found.first[head] + pair[:, 1] + size - 1)
        return _cut(block_texts["id"], own.raw, own.offsets, np.concatenate(begin), np.concatenate(end))

    anchors = texts.groupBy("block").applyInArrow(lean(send), ANCHORS)
    answers = anchors.groupBy("bucket").applyInArrow(lean(_answer_anchors), ANSWERED)
    sent = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lean(fragments), SENT)
    found = sent.groupBy("bucket").applyInArrow(lean(find), FOUND)
    both = blocks.answers_for(
        (answers, [F.col("hashes").alias("a"), F.col("crowded").alias("b")]),
        (found, [F.col("at").alias("a"), F.col("ranges").alias("b")]),
    )
    return texts.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(lean(cut), KEPT)


def _cut(ids: pa.ChunkedArray, raw: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    """Rows without the bytes that the ranges cover; a range lies within a text."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    removed, spans, kept, sizes = [], [], [], [np.zeros(1, dtype=np.int64)]
    for a, b in chunks(offsets, PIECE):
        base, part = offsets[a], raw[offsets[a] : offsets[b]]
        some = slice(np.searchsorted(begin, base), np.searchsorted(begin, offsets[b]))
        steps = np.zeros(len(part) + 1, dtype=np.int32)
        np.add.at(steps, begin[some] - base, 1)
        np.add.at(steps, end[some] - base, -1)
        gone = np.cumsum(steps[:-1], dtype=np.int32) > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        rows = offsets[a : b + 1] - base
        heads = rows[:-1][np.diff(rows) > 0]
        opens[heads] = gone[heads]
        total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[rows])
        removed.append(total(gone))
        spans.append(total(opens))
        sizes.append(sizes[-1][-1] + np.cumsum(np.diff(rows) - removed[-1]))
        kept.append(part[~gone])
    join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.table(
        {
            "id": ids,
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(join(removed, np.int64), pa.int64()),
            "n_spans": pa.array(join(spans, np.int64), pa.int64()),
            "kept": text_array(join(kept, np.uint8), np.concatenate(sizes), pa.binary()),
        }
    )


def _ids(texts: pa.Table) -> np.ndarray:
    return texts["id"].fill_null(int(blocks.NO_ID)).to_numpy()


def _repeated(table: pa.Table, size: int, keep: str) -> pa.Table:
    """Which start ranges of the fragments of a bucket are repeated, for each block that must be told."""
    bucket = table["bucket"][0].as_py() if len(table) else 0

    def column(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])

    counts = [len(x) for x in table["many"].to_pylist()]
    sender = np.repeat(table["block"].to_numpy(), counts)
    place = np.arange(sum(counts)) - np.repeat(np.cumsum([0, *counts[:-1]]), counts)
    hashes = column("hashes", "<u8").reshape(-1, 2)
    anchors, ids, starts = column("anchors", "<u8"), column("ids", "<i8"), column("starts", "<i8")
    many, sizes = column("many", np.uint8) > 0, column("sizes", "<u4").astype(np.int64)
    picks = column("offsets", "<u4").astype(np.int64)
    text = column("texts", np.uint8)
    begin = np.cumsum(sizes) - sizes

    # Distinct fragments, in the order of their first copies within an anchor.
    order = np.lexsort((starts, sender, ids, hashes[:, 1], hashes[:, 0], anchors))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]).any(axis=1)
    heads = order[fresh]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    several = np.bincount(group, minlength=len(heads)) > 1
    several |= np.bincount(group, weights=many, minlength=len(heads)) > 0
    by_place = heads[np.lexsort((starts[heads], sender[heads], ids[heads], anchors[heads]))]

    groups = [by_place[s] for _, s in blocks.each(anchors[by_place]) if s.stop - s.start > 1]
    ranges = _group_ranges(text, begin, sizes, picks, groups, size, keep, SLICE)

    rows: dict[int, list] = {}
    first = np.zeros(len(order), dtype=bool)
    first[heads] = True
    for k in range(len(sender)):
        if keep == "none":
            spans = None if several[group[k]] and not many[k] else ranges.get(k) if not several[group[k]] else ()
        else:
            spans = ranges.get(k) if first[k] else None
        if spans is None and (several[group[k]] and (keep == "none" or not first[k])):
            spans = np.array([[0, sizes[k] - size + 1]])
        if spans is not None and len(spans):
            rows.setdefault(int(sender[k]), []).append((place[k], spans))
    return blocks.frame(
        FOUND,
        [
            (
                block,
                bucket,
                np.concatenate([np.full(len(s), p) for p, s in found]).astype("<u4").tobytes(),
                np.concatenate([s for _, s in found]).astype("<u4").tobytes(),
            )
            for block, found in rows.items()
        ],
    )


def _group_ranges(text, begin, sizes, picks, groups: list[np.ndarray], size: int, keep: str, width: int) -> dict[int, np.ndarray]:
    """Repeated start ranges of the fragments of each group; a group of more than ``SORTED`` bytes is cut."""
    ranges: dict[int, np.ndarray] = {}
    todo: list[np.ndarray] = []
    volume = 0
    for own in groups:
        bytes_ = int(sizes[own].sum())
        if bytes_ > SORTED:
            ranges |= _sliced(text, begin, sizes, picks, own, size, keep, width)
            continue
        if todo and volume + bytes_ > SORTED:
            ranges |= _ranges(text, begin, sizes, np.concatenate(todo), size, keep)
            todo, volume = [], 0
        todo.append(own)
        volume += bytes_
    return ranges | _ranges(text, begin, sizes, np.concatenate(todo), size, keep) if todo else ranges


def _ranges(text, begin, sizes, fragments: np.ndarray, size: int, keep: str) -> dict[int, np.ndarray]:
    """Repeated start ranges of each fragment: those whose longest factor reaches ``size``."""
    own = sizes[fragments]
    ends = np.cumsum(own)
    heads = ends - own
    source = np.repeat(begin[fragments] - heads, own) + np.arange(ends[-1])
    steps = np.zeros(ends[-1] + 1, dtype=np.int32)
    np.add.at(steps, heads, 1)
    np.add.at(steps, ends - size + 1, -1)
    owned = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
    order, common = suffix_order(text[source], owned, size)
    factor = longest_factors(order, common)
    if keep == "none":
        factor = np.maximum(factor, longest_factors(order, common, later=True))
    starts = np.sort(order[factor >= size])
    if not len(starts):
        return {}
    number = np.searchsorted(ends, starts, side="right")
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (starts[1:] != starts[:-1] + 1) | (number[1:] != number[:-1])
    at = np.flatnonzero(fresh)
    last = np.concatenate((at[1:], [len(starts)])) - 1
    pairs = np.stack([starts[at] - heads[number[at]], starts[last] - heads[number[at]] + 1], axis=1)
    return {int(fragments[k]): pairs[s] for k, s in blocks.each(number[at])}


def _sliced(text, begin, sizes, picks, fragments: np.ndarray, size: int, keep: str, width: int) -> dict[int, np.ndarray]:
    """As ``_ranges``, for an anchor with many fragments, in pieces of ``width`` distances.

    Pieces with equal bytes are looked at once, and only with others that have their core. Pieces
    of one distance are all core, so a group that is cut again and again has no others at last.
    """
    start = begin[fragments]
    which, first, last, core = _pieces(start, start + sizes[fragments] - size, start + picks[fragments], width)
    cores, hashes = _digests(text, core, core + size - width + 1), _digests(text, first, last + size)
    order = np.lexsort((which, hashes[:, 1], hashes[:, 0], cores[:, 1], cores[:, 0]))
    fresh, opens = np.ones(len(order), dtype=bool), np.ones(len(order), dtype=bool)
    opens[1:] = (cores[order][1:] != cores[order][:-1]).any(axis=1)
    fresh[1:] = opens[1:] | (hashes[order][1:] != hashes[order][:-1]).any(axis=1)
    number = np.cumsum(fresh) - 1
    several = np.bincount(number)[number] > 1
    whole = np.zeros(len(order), dtype=bool)
    whole[order[several if keep == "none" else ~fresh]] = True

    heads = order[fresh]
    at = np.flatnonzero(opens[fresh])
    ends = np.concatenate((at[1:], [len(heads)]))
    groups = [np.sort(heads[a:b]) for a, b in zip(at.tolist(), ends.tolist(), strict=True) if b - a > 1]
    some = _group_ranges(text, first, last - first + size, core - first, groups, size, keep, width // 2)
    out: dict[int, list] = {}
    for k in np.flatnonzero(whole).tolist():
        out.setdefault(int(which[k]), []).append(np.array([[first[k], last[k] + 1]]))
    for k, pairs in some.items():
        if not whole[k]:
            out.setdefault(int(which[k]), []).append(pairs + first[k])
    return {int(fragments[k]): np.concatenate(found) - start[k] for k, found in out.items()}
