"""Product codes of integer vectors, with per-dimension value dictionaries.

Components become integers ``floor(scale * x)``; vectors are cut into equal consecutive parts,
and each part is replaced by the number of the nearest entry of its codebook. Codebooks begin
as the parts of the vectors with the smallest ids (nulls last, ties by the vector) and are
improved in rounds: every part goes to its nearest entry (ties to the lower number), every
used entry becomes the floor of the mean of its parts.

Vectors are written once, in blocks: for each dimension the *dictionary* of its distinct
integers, and for each vector the places of its components there. In a round a task tabulates
the squared differences of every distinct integer to all entries, so that the distances of a
part are gathers from these tables and sums over them; how often an integer went to an entry
gives the sums for the means. A task returns one row for each used entry and position, and
the driver sees as many sums as the codebooks have integers, whatever the number of vectors.

Everything is exact: 64-bit integers where they are wide enough, else Python's, and sums in
two decimals. Which vectors take part, see ``vectors``; null ids and labels are kept, equal
rows are coded alike, and no vector gives no codes. An error that does not fit a bigint is
null, and so is the sum over its label. Other columns are not carried.
"""

from __future__ import annotations

from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged
from tidelog.llm.vectors import bits, floors, prepared, whole

#: Vectors of a block: their places in a dictionary fit 16 bits.
BLOCK_ROWS = 16_384
SUMS = "part int, entry int, position int, n bigint, high decimal(38,0), low decimal(38,0)"
_LOW = 60

#: A codebook for each part: entries of as many integers as the part has components.
Codebooks = list[list[list[int]]]


def codebooks_sha256(books: Codebooks) -> str:
    """Digest of all integers by part, entry and position, joined by commas."""
    return sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def decode(code: str, books: Codebooks) -> list[int]:
    """The integers that a code stands for."""
    return [x for p, book in enumerate(books) for x in book[int(code[2 * p : 2 * p + 2], 16)]]


def _packed(batch: pa.RecordBatch, size: int, scale: int) -> pa.RecordBatch:
    """A block as one row: ids, labels, and for each dimension a dictionary and places in it."""
    values = floors(batch.column("vector"), size, scale)
    words, places = zip(*(np.unique(column, return_inverse=True) for column in values.T), strict=True)
    one = lambda array: pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), array)
    return pa.RecordBatch.from_pydict(
        {
            "ids": one(batch.column("id")),
            "labels": one(batch.column("label")),
            "lengths": pa.array([np.array([len(w) for w in words], "<i4").tobytes()], pa.binary()),
            "words": pa.array([np.concatenate(words).astype("<f8").tobytes()], pa.binary()),
            "places": pa.array([np.stack(places).astype("<u2").tobytes()], pa.binary()),
        }
    )


class _Block:
    """A block's vectors against codebooks."""

    def __init__(self, batch: pa.RecordBatch, row: int, books: Codebooks):
        data = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)
        lengths = data("lengths", "<i4")
        self.words = np.split(data("words", "<f8"), np.cumsum(lengths)[:-1])
        self.places = data("places", "<u2").reshape(len(lengths), -1)
        self.width = len(books[0][0])
        entries = np.array(books, dtype=object)
        largest = max(bits(np.concatenate(self.words)), *(int(x).bit_length() for x in entries.ravel()))
        #: Bits of a squared distance over all dimensions.
        self.room = 2 * (largest + 1) + np.log2(len(lengths))
        self.entries = entries.astype(np.int64) if self.room < 63 else entries

    def nearest(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """The number and the squared distance of each vector's nearest entry of a codebook."""
        total = None
        for k in range(self.width):
            d = part * self.width + k
            words = whole(self.words[d], self.room)
            table = (words[:, None] - self.entries[part, :, k][None, :]) ** 2
            gathered = table[self.places[d]]
            total = gathered if total is None else total + gathered
        best = total.argmin(axis=1)
        return best, total[np.arange(len(best)), best]

    def sums(self, part: int, best: np.ndarray) -> np.ndarray:
        """For each entry the sum of its parts, position by position."""
        entries = self.entries.shape[1]
        out = []
        for k in range(self.width):
            d = part * self.width + k
            words = self.words[d]
            often = np.bincount(self.places[d].astype(np.int64) * entries + best, minlength=len(words) * entries)
            often = often.reshape(len(words), entries)
            exact = whole(words, bits(words) + np.log2(len(best) + 1) + 1)
            out.append(exact @ often.astype(exact.dtype))
        return np.stack(out, axis=1)


def _round(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks after one assignment of all vectors."""
    parts, entries, width = len(books), len(books[0]), len(books[0][0])

    def add_up(batches):
        n = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=object)
        for batch in batches:
            for row in range(len(batch)):
                block = _Block(batch, row, books)
                for p in range(parts):
                    best, _ = block.nearest(p)
                    n[p] += np.bincount(best, minlength=entries)
                    sums[p] += block.sums(p, best)
        p, e, k = (x.ravel() for x in np.indices((parts, entries, width)))
        used = n[p, e] > 0
        p, e, k = p[used], e[used], k[used]
        found = [int(x) for x in sums[p, e, k]]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(p, pa.int32()),
                "entry": pa.array(e, pa.int32()),
                "position": pa.array(k, pa.int32()),
                "n": pa.array(n[p, e], pa.int64()),
                "high": pa.array([Decimal(x >> _LOW) for x in found], pa.decimal128(38, 0)),
                "low": pa.array([Decimal(x & (1 << _LOW) - 1) for x in found], pa.decimal128(38, 0)),
            }
        )

    total = blocks.mapInArrow(add_up, SUMS).groupBy("part", "entry", "position")
    fresh = [[list(entry) for entry in book] for book in books]
    for r in total.agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        fresh[r["part"]][r["entry"]][r["position"]] = ((int(r["high"]) << _LOW) + int(r["low"])) // r["n"]
    return fresh


def _coded(blocks: DataFrame, books: Codebooks, kind: str) -> DataFrame:
    """``id, label, code, error`` of each vector."""

    def code(batches):
        for batch in batches:
            for row in range(len(batch)):
                block = _Block(batch, row, books)
                best, distance = zip(*(block.nearest(p) for p in range(len(books))), strict=True)
                error = sum(distance[1:], distance[0])
                text = np.stack(best, axis=1).astype(np.uint8).tobytes().hex()
                step = 2 * len(books)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("ids")[row].values,
                        "label": batch.column("labels")[row].values,
                        "code": pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string()),
                        "error": pa.array([int(x) if x < 1 << 63 else None for x in error], pa.int64()),
                    }
                )

    return blocks.mapInArrow(code, f"id bigint, label {kind}, code string, error bigint")


def compress(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 4096,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
) -> tuple[DataFrame, Codebooks]:
    """``id, label, code, error, label_error`` for each vector that takes part, and the codebooks.

    ``code`` has two hexadecimal digits for each part; ``error`` is the squared distance to what
    the code stands for, ``label_error`` its sum over equal labels, nulls together.
    """
    kind = df.schema[label].dataType.simpleString()
    rows, size, _ = prepared(df, id_column, vector, label=F.col(label))
    if size % parts or not 1 <= entries <= 256:
        raise ValueError(f"vectors of {size} components, {parts} parts, {entries} entries")
    if not size:
        return rows.selectExpr("id", "label", "'' as code", "0L as error", "0L as label_error"), []

    def pack(batches):
        for batch in batches:
            for k in range(0, len(batch), BLOCK_ROWS):
                yield _packed(batch.slice(k, BLOCK_ROWS), size, scale)

    blocks = staged(
        rows.mapInArrow(pack, f"ids array<bigint>, labels array<{kind}>, lengths binary, words binary, places binary"),
        "blocks",
    )
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = [[int(x) for x in np.floor(np.array(r["vector"]) * float(scale))] for r in first]
    width = size // parts
    books = [[v[p * width : (p + 1) * width] for v in start] for p in range(parts)]
    for _ in range(rounds):
        books = _round(blocks, books)
    coded = staged(_coded(blocks, books, kind), "codes")
    whole_sum = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy("label").agg(whole_sum.alias("total")).select("label", F.expr("try_cast(total as bigint)").alias("label_error"))
    joined = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select("c.id", "c.label", "c.code", "c.error", "s.label_error"), books
