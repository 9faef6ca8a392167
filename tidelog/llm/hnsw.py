"""Embedding near-dedup with hierarchical navigable small-world graphs, one for each shard.

Vectors are compared only where labels are equal and not null. Equal vectors of a label are
one vector with a multiplicity. The vectors of a label go to shards of bounded size by their
hash; each shard builds a graph, and every shard is queried with the vectors of every shard
of its label (of two shards, one asks the other).

A query is a beam search. Where all of a beam lies within the threshold it is widened for
that vector, since there may be more. An *audit* answers ``AUDIT`` queries of a shard by brute
force too, on two counts: the links, and the ten nearest others, which tell how good the search
is where links are rare. As long as the search finds too few of either, the beam is doubled for all;
once it would be a quarter of the shard, all are compared. What is found is verified by cosine
in double precision, so no link is below the threshold.

Shard against shard gives each vector a number of links and a spanning forest of the links,
not all pairs; components are joined from the forests.

Labels are compared as text. Vectors that are null, empty, of zero length, or that hold null or non-finite components
link with nothing, nor do those with a null label; vectors of different sizes are not
compared. Null ids are after all others. Other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged
from tidelog.llm.components import components

NEIGHBOURS, BEAM, BUILD_BEAM = 16, 48, 64
SHARD_ROWS, AUDIT, RECALL = 20_000, 512, 0.99
#: Nearest others that an audit looks for, and the share of them that a search must find.
NEAREST, NEAREST_RECALL = 10, 0.9
GRAPH = "label string, size int, shard int, nodes binary, weights binary, vectors binary, levels int, links binary"
FOUND = "node bigint, n bigint, other bigint"


class Graph:
    """Vectors (unit length, 32 bits) and, for each level, up to a number of neighbours of each."""

    def __init__(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS):
        self.vectors = vectors
        self.most = neighbours
        self.links: list[np.ndarray] = []
        self.entry = np.zeros(0, dtype=np.int64)

    def build(self, beam: int = BUILD_BEAM, seed: int = 5) -> Graph:
        """Insert all vectors in random order, in batches that grow with the graph."""
        n = len(self.vectors)
        random = np.random.default_rng(seed)
        level = np.minimum((-np.log(1 - random.random(n)) / math.log(self.most)).astype(int), 8)
        order = random.permutation(n)
        top = int(level.max(initial=0))
        self.links = [
            np.full((n, self.most * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(top + 1)
        ]
        heads = [np.zeros(0, dtype=np.int64) for _ in range(top + 1)]  # a way in on each level
        done = 0
        while done < n:
            batch = order[done : done + min(max(1, done // 2), 512)]
            near = np.zeros((len(batch), 0), dtype=np.int64)
            for k in range(top, -1, -1):
                here = level[batch] >= k
                if len(heads[k]):
                    start = np.concatenate((near, np.tile(heads[k], (len(batch), 1))), axis=1)
                    found, _ = self.search(self.vectors[batch], start, k, beam)
                else:
                    found = np.full((len(batch), 1), -1, dtype=np.int64)
                if here.any():
                    self._connect(batch[here], found[here], k)
                near = found[:, :4]
            for k in range(top + 1):
                if not len(heads[k]):
                    heads[k] = batch[level[batch] >= k][:1]
            done += len(batch)
        self.entry = next((h for h in reversed(heads) if len(h)), np.zeros(0, dtype=np.int64))
        return self

    def _connect(self, batch: np.ndarray, found: np.ndarray, k: int) -> None:
        """Link new vectors with what their searches found, and with each other."""
        width = self.links[k].shape[1]
        mates = self.vectors[batch] @ self.vectors[batch].T
        np.fill_diagonal(mates, -np.inf)
        few = min(len(batch), width)
        close = np.argpartition(-mates, few - 1, axis=1)[:, :few]
        close_ids = np.where(np.isfinite(np.take_along_axis(mates, close, axis=1)), batch[close], -1)
        self.links[k][batch] = self._choose(batch, np.concatenate((found, close_ids), axis=1), width)
        # The other direction: each chosen neighbour weighs its old and new links anew.
        chosen = self.links[k][batch]
        source = np.repeat(batch, width)[chosen.ravel() >= 0]
        target = chosen.ravel()[chosen.ravel() >= 0].astype(np.int64)
        if not len(target):
            return
        sims = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        first = np.concatenate(([True], target[1:] != target[:-1]))
        head = np.flatnonzero(first)
        number = np.cumsum(first) - 1
        place = np.arange(len(target)) - head[number]
        fits = place < 2 * width
        fresh = np.full((len(head), 2 * width), -1, dtype=np.int64)
        fresh[number[fits], place[fits]] = source[fits]
        targets = target[head]
        self.links[k][targets] = self._choose(
            targets, np.concatenate((self.links[k][targets].astype(np.int64), fresh), axis=1), width
        )

    def _choose(self, nodes: np.ndarray, options: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` links for each node: near ones that are not nearer to one already
        chosen, then the nearest of the rest."""
        out = np.full((len(nodes), width), -1, dtype=np.int32)
        for a in range(0, len(nodes), 256):
            own, some = nodes[a : a + 256], np.sort(options[a : a + 256], axis=1)
            again = np.zeros_like(some, dtype=bool)
            again[:, 1:] = some[:, 1:] == some[:, :-1]
            bad = again | (some < 0) | (some == own[:, None])
            sims = np.einsum("ijk,ik->ij", self.vectors[np.maximum(some, 0)], self.vectors[own])
            sims[bad] = -np.inf
            most = min(some.shape[1], 4 * width)
            order = np.argsort(-sims, axis=1)[:, :most]
            some, sims = np.take_along_axis(some, order, axis=1), np.take_along_axis(sims, order, axis=1)
            held = self.vectors[np.maximum(some, 0)]
            between = held @ held.transpose(0, 2, 1)
            picked = np.zeros(some.shape, dtype=bool)
            nearest = np.full(some.shape, -np.inf, dtype=np.float32)
            for j in range(most):
                take = (sims[:, j] > nearest[:, j]) & (picked.sum(axis=1) < width) & np.isfinite(sims[:, j])
                picked[take, j] = True
                nearest[take] = np.maximum(nearest[take], between[take, j])
            rank = np.where(np.isfinite(sims), np.where(picked, 0, 1) * most + np.arange(most), 3 * most)
            best = np.argsort(rank, axis=1)[:, :width]
            ids = np.where(np.take_along_axis(rank, best, axis=1) < 3 * most, np.take_along_axis(some, best, axis=1), -1)
            out[a : a + 256, : ids.shape[1]] = ids
        return out

    def search(self, queries: np.ndarray, start: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beams of all queries at level ``k``: ids (-1: none) and similarities, best first."""
        q, n = len(queries), len(self.vectors)
        ids = np.full((q, beam), -1, dtype=np.int64)
        sims = np.full((q, beam), -np.inf, dtype=np.float32)
        open_ = np.zeros((q, beam), dtype=bool)
        seen = np.zeros((q, n), dtype=bool)
        who = np.repeat(np.arange(q), start.shape[1])
        self._offer(queries, ids, sims, open_, seen, who, start.ravel())
        width = max(4, beam // 16)
        while True:
            active = np.flatnonzero(open_.any(axis=1))
            if not len(active):
                return ids, sims
            ranked = np.where(open_[active], sims[active], -np.inf)
            few = min(width, beam)
            at = np.argpartition(-ranked, few - 1, axis=1)[:, :few] if few < beam else np.tile(np.arange(beam), (len(active), 1))
            good = np.take_along_axis(open_[active], at, axis=1)
            rows, columns = np.repeat(active, few)[good.ravel()], at.ravel()[good.ravel()]
            open_[rows, columns] = False
            near = self.links[k][ids[rows, columns]]
            self._offer(queries, ids, sims, open_, seen, np.repeat(rows, near.shape[1]), near.ravel().astype(np.int64))

    def _offer(self, queries, ids, sims, open_, seen, who, what) -> None:
        """Take vectors that a query has not seen into its beam, if they are good enough."""
        n, beam = len(self.vectors), ids.shape[1]
        ok = what >= 0
        who, what = who[ok], what[ok]
        fresh = ~seen[who, what]
        pair = np.unique(who[fresh] * n + what[fresh])
        who, what = pair // n, pair % n
        if not len(who):
            return
        seen[who, what] = True
        value = np.einsum("ij,ij->i", queries[who], self.vectors[what])
        better = value > sims.min(axis=1)[who]
        who, what, value = who[better], what[better], value[better]
        if not len(who):
            return
        rows, head, count = np.unique(who, return_index=True, return_counts=True)
        place = np.arange(len(who)) - np.repeat(head, count)
        number = np.repeat(np.arange(len(rows)), count)
        more = int(count.max())
        all_ids = np.concatenate((ids[rows], np.full((len(rows), more), -1)), axis=1)
        all_sims = np.concatenate((sims[rows], np.full((len(rows), more), -np.inf, dtype=np.float32)), axis=1)
        all_open = np.concatenate((open_[rows], np.zeros((len(rows), more), dtype=bool)), axis=1)
        all_ids[number, beam + place], all_sims[number, beam + place], all_open[number, beam + place] = what, value, True
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        for target, source in ((ids, all_ids), (sims, all_sims), (open_, all_open)):
            target[rows] = np.take_along_axis(source, best, axis=1)

    def beams(self, queries: np.ndarray, own: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Down the levels, then the beams of the lowest: ids (-1: none) and similarities, best first."""
        start = np.tile(self.entry, (len(queries), 1))
        for k in range(len(self.links) - 1, 0, -1):
            start = self.search(queries, start, k, 4)[0]
        if own is not None:
            start = np.concatenate((start, own[:, None]), axis=1)
        return self.search(queries, start, 0, min(width, len(self.vectors)))

    def within(self, queries: np.ndarray, own: np.ndarray | None, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) with similarity of at least ``least``, as far as beams reach.

        ``own``: where the queries are vectors of this graph, their numbers, at which the
        search begins too. Beams that are full of near vectors are widened.
        """
        found_q, found_v = [], []
        step = max(16, min(512, (1 << 24) // max(1, len(self.vectors))))
        for a in range(0, len(queries), step):
            todo = np.arange(a, min(a + step, len(queries)))
            width = min(beam, len(self.vectors))
            while len(todo):
                ids, sims = self.beams(queries[todo], None if own is None else own[todo], width)
                near = (sims >= least) & (ids >= 0)
                full = near.all(axis=1) & (width < len(self.vectors))
                rows, columns = np.nonzero(near & ~full[:, None])
                found_q.append(todo[rows])
                found_v.append(ids[rows, columns])
                todo = todo[full]
                width = min(width * 4, len(self.vectors))
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return join(found_q), join(found_v)


def _all_within(graph: Graph, queries: np.ndarray, some: np.ndarray, least: float) -> np.ndarray:
    """Pairs of queries numbered ``some`` with vectors within the threshold, as one number each."""
    q, v = np.nonzero(queries[some] @ graph.vectors.T >= least)
    return some[q] * len(graph.vectors) + v


def audited(
    graph: Graph, queries: np.ndarray, own: np.ndarray | None, least: float, recall: float = RECALL, audit: int = AUDIT
) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs within the threshold, and the beam at which the audit passed.

    The audit is a fixed number of random queries, answered by brute force too, and looks at two
    counts: of the links (the pair of a vector with itself is none) the search must find ``recall``,
    and of the ``NEAREST`` nearest others ``NEAREST_RECALL``. The second has no rare case: it
    judges the search where the sample holds few links or none. All other queries are answered
    by the graph.
    """
    n = len(graph.vectors)
    order = np.random.default_rng(3).permutation(len(queries))
    sample, rest = order[:audit], order[audit:]

    def links(pairs: np.ndarray) -> np.ndarray:
        return pairs if own is None else pairs[pairs % n != own[pairs // n]]

    def search(some: np.ndarray, beam: int) -> np.ndarray:
        q, v = graph.within(queries[some], None if own is None else own[some], least, beam)
        return some[q] * n + v

    known = np.concatenate([np.zeros(0, np.int64), *[_all_within(graph, queries, sample[k : k + 128], least) for k in range(0, len(sample), 128)]])
    true, beam = links(known), BEAM
    itself = None if own is None else own[sample]
    bounds = _nearest_similarity(graph, queries[sample], itself)
    while (
        np.isin(true, search(sample, beam)).sum() < recall * len(true)
        or _nearest_found(graph, queries[sample], itself, bounds, beam) < NEAREST_RECALL
    ):
        beam *= 2
        if beam * 4 >= n:
            beam = n
            break
    # Of the sample all pairs are known, whatever the search found.
    if beam == n:
        found = [_all_within(graph, queries, rest[k : k + 128], least) for k in range(0, len(rest), 128)]
    else:
        found = [search(rest, beam)]
    pairs = np.concatenate((known, *found))
    return pairs // n, pairs % n, beam


def _nearest_similarity(graph: Graph, queries: np.ndarray, own: np.ndarray | None) -> np.ndarray:
    """For each query, how near the least near of its ``NEAREST`` nearest others is."""
    few = min(NEAREST, len(graph.vectors) - (own is not None))
    out = []
    for k in range(0, len(queries), 128):
        sims = queries[k : k + 128] @ graph.vectors.T
        if own is not None:
            sims[np.arange(len(sims)), own[k : k + 128]] = -np.inf
        out.append(np.partition(sims, -few, axis=1)[:, -few] if few > 0 else np.full(len(sims), np.inf))
    return np.concatenate(out) if out else np.zeros(0)


def _nearest_found(graph: Graph, queries: np.ndarray, own: np.ndarray | None, bounds: np.ndarray, beam: int) -> float:
    """The share of the nearest others that a search with this beam finds."""
    few = min(NEAREST, len(graph.vectors) - (own is not None))
    if few <= 0 or not len(queries):
        return 1.0
    found = 0
    for k in range(0, len(queries), 64):
        ids, sims = graph.beams(queries[k : k + 64], None if own is None else own[k : k + 64], beam)
        good = (ids >= 0) & (sims >= bounds[k : k + 64, None] - 1e-6)
        if own is not None:
            good &= ids != own[k : k + 64, None]
        found += int(np.minimum(good.sum(axis=1), few).sum())
    return found / (few * len(queries))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; divided by the largest component first, so that no square is lost or infinite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that leave components as they are: each vertex with the least one it reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == before).all():
            break
    return nodes, nodes[root]


def _pack(table: pa.Table, seed: int) -> pa.Table:
    """A shard's graph as one row."""
    size = table["size"][0].as_py()
    order = np.argsort(table["node"].to_numpy(), kind="stable")
    vectors = np.stack(table["vector"].combine_chunks().flatten().to_numpy().reshape(-1, size)[order]).astype(np.float64)
    graph = Graph(unit(vectors).astype(np.float32)).build(seed=seed)
    kept = [*graph.links, np.pad(graph.entry.astype(np.int32), (0, 1), constant_values=-1)[:1].reshape(1, 1)]
    return pa.table(
        {
            "label": table["label"][:1],
            "size": table["size"][:1],
            "shard": table["shard"][:1],
            "nodes": pa.array([table["node"].to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
            "weights": pa.array([table["weight"].to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
            "levels": pa.array([len(graph.links)], pa.int32()),
            "links": pa.array([b"".join(x.astype("<i4").tobytes() for x in kept)], pa.binary()),
        }
    )


def _unpack(nodes: bytes, vectors: bytes, levels: int, links: bytes) -> tuple[np.ndarray, np.ndarray, Graph]:
    ids = np.frombuffer(nodes, "<i8")
    exact = np.frombuffer(vectors, "<f8").reshape(len(ids), -1)
    exact = unit(exact)
    graph = Graph(exact.astype(np.float32))
    flat = np.frombuffer(links, "<i4")
    graph.entry = flat[-1:].astype(np.int64)
    at = 0
    for k in range(levels):
        width = NEIGHBOURS * (2 if k == 0 else 1)
        graph.links.append(flat[at : at + width * len(ids)].reshape(len(ids), width))
        at += width * len(ids)
    return ids, exact, graph


def near_duplicates(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    shard_rows: int = SHARD_ROWS,
    recall: float = RECALL,
) -> DataFrame:
    """``id, n_links, component`` for each row: other rows linked directly, least id reachable."""
    rows = staged(
        df.select(
            F.col(id_column).cast("bigint").alias("id"),
            F.col(label).cast("string").alias("label"),
            F.col(vector).cast("array<double>").alias("vector"),
        )
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("v1", F.xxhash64(F.lit(1), "vector"))
        .withColumn("v2", F.xxhash64(F.lit(2), "vector")),
        "vectors",
    )
    fine = (
        F.col("label").isNotNull()
        & F.exists("vector", lambda x: x != 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    good = rows.where(F.coalesce(fine, F.lit(False)))
    # Equal vectors of a label are one, told apart by 128 bits.
    same = ["label", "v1", "v2"]
    heads = staged(good.groupBy(*same).agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("weight")), "heads")
    distinct = good.select("node", "vector").join(heads, "node").withColumn("size", F.size("vector"))
    counts = distinct.groupBy("label", "size").agg(F.count(F.lit(1)).alias("m"))
    sharded = distinct.join(counts, ["label", "size"]).select(
        "label",
        "size",
        F.pmod(F.col("v1"), F.ceil(F.col("m") / shard_rows)).cast("int").alias("shard"),
        "node",
        "weight",
        "vector",
    )
    graphs = staged(
        sharded.groupBy("label", "size", "shard").applyInArrow(lambda t: _pack(t, 5), GRAPH), "graphs"
    )
    keys = ["label", "size"]
    asked = graphs.select(*keys, F.col("shard").alias("to"))
    pairs = graphs.select(*keys, F.col("shard").alias("of")).join(asked, keys).where("to <= of")
    side = lambda name, *columns: graphs.select(
        *keys, F.col("shard").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns]
    )
    work = (
        pairs.join(side("of", "nodes", "weights", "vectors"), [*keys, "of"])
        .join(side("to", "nodes", "weights", "vectors", "levels", "links"), [*keys, "to"])
    )

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _links(row, least, recall)

    found = staged(work.mapInArrow(ask, FOUND), "found")
    per_node = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    classes = (
        heads.join(per_node, "node", "left")
        .join(roots, "node", "left")
        .select(
            *same,
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    # A row's key: its class's root, or itself where it links with nothing.
    flagged = rows.select("id", "node", *same, F.coalesce(fine, F.lit(False)).alias("fine"))
    located = (
        flagged.where("fine")
        .join(classes, same)
        .select("id", "n_links", "root")
        .unionAll(flagged.where("not fine").select("id", F.lit(0).cast("bigint"), F.col("node")))
    )
    least_id = located.groupBy("root").agg(F.min("id").alias("component"))
    return located.join(least_id, "root").select("id", "n_links", "component")


def _links(row: dict, least: float, recall: float) -> pa.RecordBatch:
    """Link counts and a spanning forest of one shard's vectors against another's."""
    ids, exact, graph = _unpack(row["to_nodes"], row["to_vectors"], row["to_levels"], row["to_links"])
    weights = np.frombuffer(row["to_weights"], "<i8")
    itself = row["to"] == row["of"]
    if itself:
        asking, others, other_weights = ids, exact, weights
    else:
        asking = np.frombuffer(row["of_nodes"], "<i8")
        others = np.frombuffer(row["of_vectors"], "<f8").reshape(len(asking), -1)
        others = unit(others)
        other_weights = np.frombuffer(row["of_weights"], "<i8")
    own = np.arange(len(ids)) if itself else None
    q, v, _ = audited(graph, others.astype(np.float32), own, least - 1e-5, recall)
    if itself:  # either direction is the link of both
        a, b = np.minimum(q, v), np.maximum(q, v)
        pair = np.unique(a[a < b] * len(ids) + b[a < b])
        q, v = pair // len(ids), pair % len(ids)
    cosine = np.concatenate(
        [np.einsum("ij,ij->i", others[q[k : k + 65536]], exact[v[k : k + 65536]]) for k in range(0, len(q), 65536)]
        or [np.zeros(0)]
    )
    q, v = q[cosine >= least], v[cosine >= least]
    nodes = np.concatenate((asking[q], ids[v]))
    counted, at = np.unique(nodes, return_inverse=True)
    number = np.bincount(at, weights=np.concatenate((weights[v], other_weights[q])), minlength=len(counted))
    child, root = _forest(asking[q], ids[v])
    return pa.RecordBatch.from_pydict(
        {
            "node": pa.array(counted, pa.int64()),
            "n": pa.array(number.astype(np.int64), pa.int64()),
            "other": pa.array(root[np.searchsorted(child, counted)], pa.int64(), mask=root[np.searchsorted(child, counted)] == counted),
        }
    )
