"""Exact top-k search by integer inner product: a Voronoi join of queries and data.

Components become integers ``floor(scale * x)``. For a query q, the score of x orders as
``|x|^2 - |q - x|^2``, so distances bound it:

1. *Pivots* are fitted on a sample. Queries and data go to the cell of their nearest pivot, with
   the distance r to it and the length.
2. *Summaries*: the queries of a cell by their largest r and range of lengths, the data of a cell
   by the k+1 rows with the smallest r. From these each query cell gets a bound that the k+1
   best scores of all of its queries reach (one row may be the query itself).
3. *Replication*: query cells near each other form groups of bounded size; a cell of more queries
   is a group cut into chunks. A row of the data goes to a group only if, by the triangle
   inequality over its pivot and over the origin, it may reach the bound of one of its cells.
4. *Local solution*: a group's data are dealt over slices of bounded size, its queries sent to
   each. A task holds one chunk and one slice, leaves out for each cell what its bound
   excludes, and finds the k best by exact products. Of the slices' results the k best remain.

Bounds allow for rounding, so no row is lost; the sample and the pivots have an effect on the
work only, never on the result. Where vectors have no clusters, bounds exclude little, and
the join is a search of every query through all rows in blocks.

Products are exact: floating-point where 53 bits hold them, else 64 bits, else Python's
integers; a score that does not fit a bigint is null, its rank is right. Which vectors take
part, see ``vectors``. Ties go to the smaller id, null ids last. Rows of equal ids are
different candidates; a row is only never its own. A query with fewer candidates has fewer
rows. Other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import staged
from tidelog.llm.vectors import bits, floors, prepared, whole

PIVOTS, SAMPLE_ROWS = 256, 4096
CHUNK_QUERIES, SLICE_ROWS = 2048, 8192
CELLS = "id bigint, query boolean, cell int, r double, length double, packed binary"
BEST = "q_row bigint, q_id bigint, id bigint, row bigint, score bigint, key binary"
_EPS = 1e-9
_SHIFT = 1 << 319


def _pack(values: np.ndarray) -> pa.Array:
    """Each row as 16-bit integers, or as floating-point numbers where these are too narrow."""
    narrow = np.abs(values).max(axis=1, initial=0) < 32768
    small, large = values.astype("<i2") if narrow.all() else np.where(narrow[:, None], values, 0).astype("<i2"), values.astype("<f8")
    return pa.array([(small if n else large)[k].tobytes() for k, n in enumerate(narrow)], pa.binary())


def _unpack(column: pa.ChunkedArray, size: int) -> np.ndarray:
    data = column.to_pylist()
    if all(len(x) == 2 * size for x in data):
        return np.frombuffer(b"".join(data), "<i2").reshape(-1, size).astype(np.float64)
    return np.stack([np.frombuffer(x, "<i2" if len(x) == 2 * size else "<f8").astype(np.float64) for x in data])


def _distances(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances to all pivots, up to rounding."""
    return (values**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * values @ pivots.T


def _pivots(sample: np.ndarray, most: int, rounds: int = 5) -> np.ndarray:
    """Centres of a sample, each the mean of the rows that are nearest to it."""
    sample = np.unique(sample, axis=0)
    random = np.random.default_rng(4)
    centres = sample[random.permutation(len(sample))[:most]].astype(np.float64)
    for _ in range(rounds):
        cell = _distances(sample, centres).argmin(axis=1)
        n = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class _Bounds:
    """What the summaries say: which rows may be among the best of which query cells."""

    def __init__(self, pivots: np.ndarray, queries: list, data: list, best: int):
        """``queries``: cell, count, r, shortest, longest; ``data``: cell, r, length of rows near their pivots."""
        self.cells = np.array([q[0] for q in queries], dtype=np.int64)
        self.count = np.array([q[1] for q in queries], dtype=np.int64)
        self.r, self.shortest, self.longest = (np.array([q[k] for q in queries], dtype=np.float64) for k in (2, 3, 4))
        self.apart = np.sqrt(np.maximum(0, ((pivots[self.cells][:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2)))
        cell, r, length = (np.array([d[k] for d in data], dtype=kind) for k, kind in ((0, np.int64), (1, np.float64), (2, np.float64)))
        farthest = np.minimum(self.apart[:, cell] + self.r[:, None] + r, self.longest[:, None] + length) * (1 + _EPS)
        reached = length**2 * (1 - _EPS) - farthest**2
        self.least = np.full(len(queries), -np.inf)
        if len(data) >= best:
            self.least = np.nan_to_num(np.sort(reached, axis=1)[:, -best], nan=-np.inf)

    def may_reach(self, cell: np.ndarray, r: np.ndarray, length: np.ndarray, some: slice | np.ndarray = slice(None)) -> np.ndarray:
        """For each row and query cell (of ``some``): can the row be among the best of a query there?"""
        at, own, length = self.apart[some][:, cell].T, self.r[some], length[:, None]
        margin = _EPS * (at + own + r[:, None] + length + self.longest[some])
        nearest = np.maximum(at - own - r[:, None], np.maximum(self.shortest[some] - length, length - self.longest[some]))
        reach = length**2 * (1 + _EPS) - np.maximum(0, nearest - margin) ** 2
        return ~(reach < self.least[some])


def _groups(bounds: _Bounds, pivots: np.ndarray, most: int) -> tuple[list[np.ndarray], list[int]]:
    """Groups of near query cells of up to ``most`` queries, and how many chunks each is cut into."""
    left, groups, chunks = set(range(len(bounds.cells))), [], []
    middle = pivots.mean(axis=0)
    while left:
        some = sorted(left)
        at = pivots[bounds.cells[some]]
        first = some[int(((at - middle) ** 2).sum(axis=1).argmax())]
        near = ((at - pivots[bounds.cells[first]]) ** 2).sum(axis=1)
        group, n = [], 0
        for k in sorted(range(len(some)), key=lambda k: near[k]):
            if group and n + bounds.count[some[k]] > most:
                break
            group.append(some[k])
            n += int(bounds.count[some[k]])
        left -= set(group)
        groups.append(np.array(sorted(group)))
        chunks.append(-(-n // most))
    return groups, chunks


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Where the k largest are, best first, of equal ones the first."""
    n = len(scores)
    if n > k:
        least = np.partition(scores, n - k)[n - k]
        above = np.flatnonzero(scores > least)
        at = np.concatenate((above, np.flatnonzero(scores == least)[: k - len(above)]))
    else:
        at = np.arange(n)
    return at[np.argsort(-scores[at], kind="stable")]


def _solve(queries: pa.Table, data: pa.Table, size: int, k: int, bounds: _Bounds) -> pa.Table:
    """The k best of a slice for each query of a chunk."""
    ids = data["id"].to_numpy() if not data["id"].null_count else data["id"].fill_null(0).to_numpy()
    absent = data["id"].is_null().to_numpy()
    order = np.lexsort((data["row"].to_numpy(), ids, absent))
    data = data.take(pa.array(order))
    rows, cell, r, length = (data[c].to_numpy() for c in ("row", "cell", "r", "length"))
    values, asked = _unpack(data["packed"], size), _unpack(queries["packed"], size)
    room = bits(values) + bits(asked) + np.log2(size)
    if room >= 53:
        values, asked = whole(values, room), whole(asked, room)
    place = {int(c): i for i, c in enumerate(bounds.cells)}
    q_cell, q_row = queries["cell"].to_numpy(), queries["row"].to_numpy()
    found_q, found_d, found_s = [], [], []
    for c in np.unique(q_cell):
        near = np.flatnonzero(bounds.may_reach(cell, r, length, np.array([place[int(c)]]))[:, 0])
        some = values if len(near) == len(values) else values[near]
        mine = np.flatnonzero(q_cell == c)
        for a in range(0, len(mine), 256):
            tile = mine[a : a + 256]
            scores = asked[tile] @ some.T
            for q, line in zip(tile.tolist(), scores, strict=True):
                at = _best(line, k + 1)
                at = at[rows[near[at]] != q_row[q]][:k]
                found_q += [q] * len(at)
                found_d += near[at].tolist()
                found_s += [int(x) for x in line[at]]
    q, d = pa.array(found_q, pa.int64()), pa.array(found_d, pa.int64())
    return pa.table(
        {
            "q_row": queries["row"].take(q),
            "q_id": queries["id"].take(q),
            "id": data["id"].take(d),
            "row": data["row"].take(d),
            "score": pa.array([s if abs(s) < 1 << 63 else None for s in found_s], pa.int64()),
            "key": pa.array([(s + _SHIFT).to_bytes(40, "big") for s in found_s], pa.binary()),
        }
    )


def top_k(
    df: DataFrame,
    query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: int = 256,
    pivots: int = PIVOTS,
    sample_rows: int = SAMPLE_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``query_id, rank, id, score`` for each row where ``query`` holds, against all other rows.

    ``sample_rows`` is how many rows (on average) the pivots are fitted on, in the driver.
    """
    rows, size, n = prepared(df, id_column, vector, query=F.coalesce(query, F.lit(False)))
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    sample = rows.where(F.rand(3) * n < sample_rows).select("vector").toArrow()["vector"].combine_chunks()
    centres = _pivots(floors(sample, size, scale), pivots) if len(sample) else np.zeros((1, size))

    def locate(batches):
        for batch in batches:
            values = floors(batch.column("vector"), size, scale)
            cell = _distances(values, centres).argmin(axis=1) if len(values) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "query": batch.column("query"),
                    "cell": pa.array(cell, pa.int32()),
                    "r": pa.array(np.linalg.norm(values - centres[cell], axis=1), pa.float64()),
                    "length": pa.array(np.linalg.norm(values, axis=1), pa.float64()),
                    "packed": _pack(values),
                }
            )

    located = staged(rows.mapInArrow(locate, CELLS).withColumn("row", F.monotonically_increasing_id()), "cells")
    asking = located.where("query")
    per_cell = asking.groupBy("cell").agg(F.count(F.lit(1)), F.max("r"), F.min("length"), F.max("length")).collect()
    close = Window.partitionBy("cell").orderBy("r")
    near = located.select("cell", "r", "length").withColumn("nth", F.row_number().over(close)).where(F.col("nth") <= k + 1)
    bounds = _Bounds(centres, sorted(per_cell), near.select("cell", "r", "length").collect(), k + 1)
    groups, chunks = _groups(bounds, centres, chunk_queries)
    if not groups:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    by_group = np.concatenate(groups)
    begin = np.cumsum([0, *map(len, groups)])[:-1]

    def wanted(batch: pa.RecordBatch) -> np.ndarray:
        """For each row and group: does the group need the row?"""
        cell, r, length = (batch.column(c).to_numpy() for c in ("cell", "r", "length"))
        return np.logical_or.reduceat(bounds.may_reach(cell, r, length, by_group), begin, axis=1)

    def tally(batches):
        total = np.zeros(len(groups), dtype=np.int64)
        for batch in batches:
            total += wanted(batch).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"group": pa.array(range(len(groups)), pa.int32()), "n": pa.array(total, pa.int64())})

    counted = located.select("cell", "r", "length").mapInArrow(tally, "group int, n bigint")
    sizes = {r["group"]: r["n"] for r in counted.groupBy("group").agg(F.sum("n").alias("n")).collect()}
    slices = [max(1, -(-sizes[g] // slice_rows)) for g in range(len(groups))]

    def replicate(batches):
        for batch in batches:
            need = wanted(batch)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(need.sum(axis=1)))), pa.int32()), pa.array(np.nonzero(need)[1], pa.int32())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "groups"])

    payload = ["id", "row", "cell", "r", "length", "packed"]
    number = lambda values, of: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col(of) + 1)
    key = ["group", "chunk", "slice"]
    spread = (
        located.select(payload)
        .mapInArrow(replicate, "id bigint, row bigint, cell int, r double, length double, packed binary, groups array<int>")
        .withColumn("group", F.explode("groups"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), number(chunks, "group") - 1)))
        .withColumn("slice", F.pmod(F.xxhash64("row"), number(slices, "group")).cast("int"))
        .select(*key, *payload)
    )
    group_of = np.zeros(len(centres), dtype=np.int64)
    for g, some in enumerate(groups):
        group_of[bounds.cells[some]] = g
    sent = (
        asking.withColumn("group", number(group_of, "cell"))
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "row"), number(chunks, "group")).cast("int"))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), number(slices, "group") - 1)))
        .select(*key, "id", "row", "cell", "packed")
    )

    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not len(queries) or not len(data):
            queries, data = queries.slice(0, 0), data.slice(0, 0)
        return _solve(queries.combine_chunks(), data.combine_chunks(), size, k, bounds)

    found = sent.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(solve, BEST)
    order = Window.partitionBy("q_row").orderBy(F.col("key").desc(), F.col("id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("q_id").alias("query_id"), "rank", "id", "score")
