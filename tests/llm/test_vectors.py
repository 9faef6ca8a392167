"""Exact top-k search and vector codes against plain computations with Python's integers."""

import collections
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tidelog.llm import vector_codes, voronoi

SCHEMA = "vec_id long, embedding array<double>, label string, cell int, row string, vector int, id int, code int"


def make_vectors(seed=2, n=420, size=8, spread=0.1):
    """Clusters, repeated vectors and rows, ties, nulls, vectors that take no part."""
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    rows = [(k, [c + r.gauss(0, spread) for c in r.choice(centres)], f"l{k % 4}" if k % 7 else None) for k in range(n)]
    rows += [(1000 + k, rows[5][1], "l1") for k in range(200)]  # a third of all are one vector
    rows += [rows[0], rows[50], rows[50], (None, rows[3][1], None), (None, rows[3][1], "l1"), (-50, rows[4][1], "l0")]
    bad = [None, [], [None] * size, [float("nan")] + [0.0] * (size - 1), [float("inf")] * size, [0.5] * (size - 1)]
    rows += [(2000 + 50 * k, v, "l0") for k, v in enumerate(bad)]
    rows += [(3000, [0.0] * size, "zero"), (3050, [-0.0] * size, "zero")]
    r.shuffle(rows)
    return rows


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA).repartition(parts)


def integers(v, scale):
    return [math.floor(scale * x) for x in v]


def good(rows, scale, size=8):
    fine = lambda v: v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    return [(i, integers(v, scale), label) for i, v, label in rows if fine(v)]


def last(i):
    return (i is None, i or 0)


# search


def brute_top(rows, k=5, size=8):
    kept, out = good(rows, 256, size), []
    for a, (i, q, _) in enumerate(kept):
        if i is None or i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(q, c, strict=True)), last(j), j) for b, (j, c, _) in enumerate(kept) if b != a]
        for rank, (score, _, j) in enumerate(sorted(scored)[:k]):
            out.append((i, rank + 1, j, -score if abs(score) < 1 << 63 else None))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    out = voronoi.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, **options)
    return sorted(map(tuple, out.select("query_id", "rank", "id", "score").collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"pivots": 5, "chunk_queries": 2, "slice_rows": 40}, {"pivots": 40, "sample_rows": 100, "slice_rows": 100}])
def test_top_k(spark, options):
    rows = make_vectors()
    assert found(spark, rows, **options) == brute_top(rows)


def test_top_k_large_numbers(spark):
    r = random.Random(9)
    for size in (3e5, 1e9, 1e30):  # past 53 bits, past 64 bits, far past
        rows = [(k * 25, [r.uniform(-size, size) for _ in range(8)], "a") for k in range(60)]
        rows += [(7, [1.0] * 8, "a"), (8, [1.0] * 8, "a"), (100, [0.5] * 8, "a")]
        assert found(spark, rows, slice_rows=20, pivots=4) == brute_top(rows)


def test_top_k_few(spark):
    rows = [(50, [1.0] * 8, None), (100, [0.5] * 8, "a"), (3, [0.0] * 8, "b")]
    assert found(spark, rows) == brute_top(rows)
    assert found(spark, rows[:1]) == [] and found(spark, rows[2:]) == []
    assert found(spark, []) == [] and found(spark, [(50, None, "a")]) == []


def test_bounds_exclude(spark):
    """Clusters far apart: a group needs little of the data."""
    r = random.Random(4)
    centres = [[r.choice((-1, 1)) for _ in range(8)] for _ in range(12)]
    rows = [(k, [c + r.gauss(0, 0.02) for c in centres[k * 7 // 50 % 12]], "a") for k in range(1500)]
    assert found(spark, rows, pivots=12, chunk_queries=3) == brute_top(rows)
    kept = good(rows, 256)
    values = voronoi.np.array([v for _, v, _ in kept], dtype=float)
    pivots = voronoi._pivots(values, 12)
    cell = voronoi._distances(values, pivots).argmin(axis=1)
    r_, length = voronoi.np.linalg.norm(values - pivots[cell], axis=1), voronoi.np.linalg.norm(values, axis=1)
    asked = voronoi.np.array([i % 50 == 0 for i, _, _ in kept])
    queries = [(int(c), 1, r_[asked & (cell == c)].max(), length[asked & (cell == c)].min(), length[asked & (cell == c)].max()) for c in set(cell[asked])]
    near = [x for c in set(cell) for x in sorted((int(c), a, b) for a, b in zip(r_[cell == c], length[cell == c], strict=True))[:6]]
    need = voronoi._Bounds(pivots, queries, near, 6).may_reach(cell, r_, length)
    assert need.mean() < 0.3


# codes


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096, size=8):
    kept = sorted(good(rows, scale, size), key=lambda r: (last(r[0]), [x for x in r[1]]))
    width = size // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def assign():
        near = lambda v, book: min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(book))
        return [[near(v[p], books[p]) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for v, at in zip(cut, assign(), strict=True):
            for p in range(parts):
                groups[p, at[p][1]].append(v[p])
        for (p, e), members in groups.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out, sums = [], collections.Counter()
    for (i, _, label), at in zip(kept, assign(), strict=True):
        error = sum(d for d, _ in at)
        sums[label] += error
        out.append([i, "".join(f"{e:02x}" for _, e in at), error, label])
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, c, fits(e), fits(sums[label])) for i, c, e, label in out), key=repr), digest


def coded(spark, rows, **options):
    out, books = vector_codes.compress(frame(spark, rows), **options)
    return sorted(map(tuple, out.select("id", "code", "error", "label_error").collect()), key=repr), books


@pytest.mark.parametrize("options", [{}, {"parts": 4, "entries": 3, "rounds": 2}, {"parts": 1, "entries": 200, "rounds": 1}])
def test_codes(spark, options, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 50)
    rows = make_vectors(seed=6)
    got, books = coded(spark, rows, **options)
    want, digest = brute_codes(rows, **options)
    assert got == want and vector_codes.codebooks_sha256(books) == digest
    assert len(vector_codes.decode(got[0][1], books)) == 8


@pytest.mark.parametrize("size", [1e4, 1e7, 1e33])
def test_codes_of_large_numbers(spark, size):
    r = random.Random(3)
    rows = [(k, [r.uniform(-size, size) for _ in range(8)], "a" if k % 3 else None) for k in range(70)]
    rows += [(70, [1e-3] * 8, "b"), (71, [0.0] * 8, "b")]
    got, books = coded(spark, rows)
    want, digest = brute_codes(rows)
    assert got == want and vector_codes.codebooks_sha256(books) == digest


def test_codes_of_few(spark):
    rows = [(4, [0.1] * 8, None), (2, [-0.1] * 8, "a"), (None, [0.3] * 8, None)]
    got, books = coded(spark, rows)
    assert (got, vector_codes.codebooks_sha256(books)) == brute_codes(rows)
    assert coded(spark, []) == ([], []) and coded(spark, [(1, None, "a")]) == ([], [])
    with pytest.raises(ValueError):
        coded(spark, rows, parts=3)
