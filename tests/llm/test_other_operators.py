"""Shards, embeddings, components, the classifier and the pipeline."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import components, hnsw, quality, sharding

SMALL = "/root/testdata/sf0.001"


# sharding


def test_matrix_sums_and_mean():
    sizes, shards = [700, 0, 41, 259, 3], 7
    total = np.zeros((len(sizes), shards))
    for seed in range(300):
        m = sharding.communication_matrix(sizes, shards, seed)
        assert m.sum(axis=1).tolist() == sizes
        assert m.sum(axis=0).max() - m.sum(axis=0).min() <= 1 and m.min() >= 0
        total += m
    expected = np.outer(sizes, [1 / shards] * shards)
    assert np.abs(total / 300 - expected).max() < 2
    large = sharding.communication_matrix([2_000_000_000, 1_500_000_001], 3, 1)
    assert large.sum(axis=1).tolist() == [2_000_000_000, 1_500_000_001] and np.ptp(large.sum(axis=0)) <= 1


def test_large_populations_are_drawn_by_the_same_law():
    random = np.random.default_rng(2)
    # 100 of 3e9 places, a hundredth of them good: nearly Poisson with mean 1, far from a normal number.
    drawn = np.array([sharding._drawn(random, 30_000_000, 2_970_000_000, 100) for _ in range(6000)])
    for k, want in enumerate((0.99**100, 100 * 0.01 * 0.99**99, 4950 * 0.01**2 * 0.99**98)):
        assert abs((drawn == k).mean() - want) < 0.025
    # The bulk: mean and spread of a draw of a million from two thousand times as many places.
    drawn = np.array([sharding._drawn(random, 1_000_000_000, 1_000_000_000, 1_000_000) for _ in range(400)])
    assert abs(drawn.mean() - 500_000) < 150 and 420 < drawn.std() < 580
    # Below the limit both ways agree.
    ours = [sharding._by_ratios(random, 400, 600, 50) for _ in range(4000)]
    theirs = random.hypergeometric(400, 600, 50, 4000)
    assert abs(np.mean(ours) - theirs.mean()) < 0.4 and abs(np.std(ours) - theirs.std()) < 0.25
    assert sharding._by_ratios(random, 5, 2, 7) == 5 and sharding._by_ratios(random, 5, 0, 3) == 3


@pytest.mark.parametrize("piece_rows", [7, 1000])
def test_shards(spark, piece_rows):
    rows = [(k if k % 3 else None, "same" if k % 2 else f"t{k}", k) for k in range(1003)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(6).withColumn("source", F.lit(1))
    out = sharding.shuffle_into_shards(df.withColumnRenamed("slot", "number"), 5, piece_rows=piece_rows).collect()
    assert sorted(r.number for r in out) == list(range(1003))
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(5)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    # neighbours of the input are spread
    ordered = [r.number for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert np.corrcoef(ordered, range(1003))[0, 1] < 0.15
    assert sharding.shuffle_into_shards(df.where("false"), 5).count() == 0
    assert len(sharding.shuffle_into_shards(df.limit(2), 5).collect()) == 2


# components


def test_components(spark):
    r = random.Random(3)
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 90)] + [(7, 7), (8, 5), (200, 201), (201, 200)]
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {q.node: q.root for q in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# embeddings


def brute_links(rows, least=0.93):
    good = []
    for i, v, label in rows:
        ok = label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, dtype=np.float64) / np.linalg.norm(v) if ok else None)
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = good[a], good[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y >= least:
                n[a] += 1
                n[b] += 1
                parent[root(a)] = root(b)
    groups = collections.defaultdict(list)
    for k, row in enumerate(rows):
        groups[root(k)].append(row[0])
    return sorted(
        ((row[0], n[k], min((i for i in groups[root(k)] if i is not None), default=None)) for k, row in enumerate(rows)),
        key=repr,
    )


@pytest.mark.parametrize("shard_rows", [40, 20_000])
def test_embeddings(spark, shard_rows):
    r = np.random.default_rng(5)
    rows = []
    for k in range(12):
        center = r.normal(size=16)
        for _ in range(1 + k * 3):
            rows.append((len(rows), (center + r.normal(scale=0.12, size=16)).tolist(), int(k % 3)))
    for _ in range(100):
        rows.append((len(rows), r.normal(size=16).tolist(), int(r.integers(3))))
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(4)]
    rows += [
        (9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] * 16, 1), (9003, [None] + [1.0] * 15, 1),
        (9004, [float("inf")] + [1.0] * 15, 1), (9005, rows[0][1], None), (9006, [1.0, 2.0], 1), (9007, [1.0, 2.01], 1),
        (9008, [], 1), (None, rows[0][1], rows[0][2]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("shard", F.lit("x"))
    got = sorted(map(tuple, hnsw.near_duplicates(df, shard_rows=shard_rows).collect()), key=repr)
    want = brute_links(rows)
    links = lambda out: sum(x[1] for x in out)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert links(got) >= 0.98 * links(want)
    if links(got) == links(want):
        assert got == want
    assert hnsw.near_duplicates(df.where("false")).count() == 0


def test_audit_widens_until_recall_is_reached():
    r = np.random.default_rng(6)
    x = np.repeat(r.normal(size=(30, 24)), 40, axis=0) + r.normal(scale=0.08, size=(1200, 24))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    graph = hnsw.Graph(x).build()
    q, v, _ = hnsw.audited(graph, x, np.arange(len(x)), 0.93)
    true = (x @ x.T >= 0.93).sum()
    assert len(q) >= 0.98 * true and ((x[q] * x[v]).sum(axis=1) >= 0.93 - 1e-6).all()


@pytest.mark.parametrize("blind", [0, 3])
@pytest.mark.parametrize("pairs", [5, 40])
def test_audit_judges_by_links_of_other_vectors(blind, pairs):
    """A graph without links finds each vector itself and nothing else; the few real links still all come."""
    r = np.random.default_rng(8)
    x = r.normal(size=(2000, 32))
    x[:pairs] = x[pairs : 2 * pairs] + r.normal(scale=0.05, size=(pairs, 32))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    true = {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.93), strict=True) if a != b}
    assert len(true) == 2 * pairs
    graph = hnsw.Graph(x).build()
    graph.links[0][:, blind:] = -1
    q, v, _ = hnsw.audited(graph, x, np.arange(len(x)), 0.93)
    got = {(a, b) for a, b in zip(q.tolist(), v.tolist(), strict=True) if a != b}
    assert len(got & true) >= 0.99 * len(true) and not got - true
    # The same from another shard, where searches begin at the entry only.
    q, v, _ = hnsw.audited(graph, x[: 2 * pairs], None, 0.93)
    assert len({*zip(q.tolist(), v.tolist(), strict=True)} & true) >= 0.99 * len(true)


# classifier


def test_classifier_on_held_out_labels(spark):
    r = random.Random(8)
    words = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(1200):
        text = " ".join(r.choice(words) for _ in range(r.randint(20, 200)))
        kind = r.choice(["good", "good", "good", "junk", "toxic"])
        if kind == "junk":
            text = text.upper().replace(" ", "!! ")
        if kind == "toxic":
            w = text.split(" ")
            w[r.randrange(len(w))] = r.choice(["vile", "nasty"]) + r.choice(["one", "two", "three"])
            text = " ".join(w)
        rows.append((k, text, f"host{k % 5}", "p", "own"))
        labels.append((k, int(kind != "junk"), int(kind == "toxic"), kind))
    rows += [(5000, None, None, None, None), (5001, "", "host1", None, ""), (None, "word1 word2", "host1", "p", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, p_low string")
    known = spark.createDataFrame(
        [x[:3] for x in labels[:800]] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int"
    )
    out = {x.doc_id: x for x in quality.classify(df, known).collect()}
    assert len(out) == len(rows)
    held = [(kind != "good", out[k].rejected) for k, _, _, kind in labels[800:]]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    none = quality.classify(df, known.where("false")).collect()
    assert len(none) == len(rows) and quality.classify(df.where("false"), known).count() == 0


def test_own_evidence_is_left_out_of_the_rates_of_sites(spark):
    r = random.Random(9)
    rows = []
    for k in range(300):
        text = " ".join(f"word{r.randrange(200)}" for _ in range(r.randint(20, 80)))
        rows.append((k, text.upper().replace(" ", "!! ") if k % 4 == 0 else text, f"host{k % 7}", "p" if k % 3 else None))
    rows += [(300 + k, text, f"single{k}", None) for k, (_, text, _, _) in enumerate(rows[:40])]
    rows += rows[:5] + [(None, "", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 4 != 0), 0) for k in range(300)], "doc_id long, quality int, toxic int")
    out = quality.classify(df, labels).collect()
    assert sorted(((x.doc_id, x.text, x.source, x.lang) for x in out), key=repr) == sorted(rows, key=repr)

    own = {id(x): 1 - (1 - x.p_low) * (1 - x.p_toxic) for x in out}
    known = spark.createDataFrame([(x.source, x.lang, own[id(x)]) for x in out], "source string, lang string, known double")
    # the half of the labelled rows that weights, and so the global rate, are fitted on
    second = [x.doc_id for x in df.where(F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(2)) == 1).collect() if x.doc_id in range(300)]
    rate = (sum(k % 4 == 0 for k in second) + 0.5) / (len(second) + 1)
    _, k_host, k_path = quality.site_counts(known, "source", "lang", "known", rate)
    for x in out:
        host = [own[id(y)] for y in out if y.source == x.source and y is not x]
        both = [own[id(y)] for y in out if (y.source, y.lang) == (x.source, x.lang) and y is not x]
        p_host = (sum(host) + k_host * rate) / (len(host) + k_host)
        assert abs(x.p_site - (sum(both) + k_path * p_host) / (len(both) + k_path)) < 1e-6
        if str(x.source).startswith("single"):
            assert abs(x.p_site - rate) < 1e-6  # nothing but the prior


def test_classifier_with_clashing_names(spark):
    rows = [(k, f"some plain words number {k}", "h", "p", k, "a", "b", "c", 0.5) for k in range(30)]
    names = ["doc_id", "body", "text", "path", "host", "_site_host", "known", "a.b`c", "P_Low"]
    df = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    out = quality.classify(df, labels, text="body", host="text", path="host")
    assert out.columns == [*names[:-1], *quality.OUTPUT]
    assert sorted(tuple(x)[:8] for x in out.collect()) == [x[:8] for x in rows]


def test_sparse_sites_are_drawn_to_the_prior(spark):
    rows = [("big", "a", 0.9)] * 400 + [("big", "b", 0.9)] * 2 + [("tiny", "a", 0.9)] + [(f"h{k}", "a", 0.1) for k in range(300)] * 20
    df = spark.createDataFrame(rows, "source string, lang string, known double")
    rates = {(r.host, r.path): r.p_site for r in quality.site_rates(df, "source", "lang", "known", 0.15).collect()}
    assert rates["big", "a"] > 0.6 > rates["tiny", "a"] > rates["h1", "a"]
    assert rates["big", "b"] > rates["tiny", "a"]


# pipeline


def test_pipeline_equals_its_parts(spark):
    import re

    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    states = [docs]
    for _, stage in cp.STAGES:
        states.append(stage(spark, states[-1], SMALL).cache())
    for state in states[1:-1]:
        assert state.columns == docs.columns
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in states]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    # the classifier keeps most documents labelled good and drops most of the others
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    bad = {x.doc_id for x in labels if x.toxic or not x.quality}
    good = {x.doc_id for x in labels} - bad
    assert len(good & ids[1]) >= 0.9 * len(good) and len(bad & ids[1]) <= 0.5 * len(bad)
    # no two of what is left are near copies, and of each group the smallest id stays
    text = {r.doc_id: r.text for r in states[2].collect()}
    grams = {}
    for i, t in text.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        grams[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    near = lambda a, b: grams[a] and 100 * len(grams[a] & grams[b]) >= 75 * len(grams[a] | grams[b])
    kept = sorted(ids[3])
    assert not any(near(a, b) for n, a in enumerate(kept) for b in kept[:n])
    assert all(any(near(a, b) for b in text if b < a) for a in ids[2] - ids[3])
    final = states[-1].collect()
    assert all(r.round_trip and r.n_tokens * 4 == len(r.ids) for r in final)
    assert {r.doc_id for r in cp.run(spark, SMALL).select("doc_id").collect()} == ids[-1]


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    import corpus_pipeline as cp

    text = lambda name, last: " ".join([*[f"{name}{k}" for k in range(60)], last])
    rows = [
        (5, text("a", "x"), "s2"), (5, text("a", "x"), "s1"), (5, text("a", "x"), "s1"), (9, text("a", "y"), "s1"),
        (7, text("b", "x"), "s1"), (7, text("a", "z"), "s1"), (11, text("c", "x"), "s1"), (11, text("c", "y"), "s1"),
        (None, text("a", "x"), "s1"), (None, text("a", "x"), "s1"), (3, "", "s1"), (3, "", "s1"), (4, None, "s1"),
        (6, text("d", "x"), "s1"), (8, text("e", "x"), "s1"), (8, text("e", "x"), "s1"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = [tuple(r) for r in cp.one_of_each(spark, docs, "").collect()]
    of_c = [r for r in got if r[0] == 11]
    assert len(of_c) == 1 and of_c[0] in rows
    want = [rows[1], rows[4], *rows[8:14], rows[14]]
    assert sorted((r for r in got if r[0] != 11), key=repr) == sorted(want, key=repr)


def test_queries_against_their_sql(spark):
    import duckdb

    from tidelog.llm import queries

    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    for name, sql in queries.oracle_sql().items():
        want = db.execute(sql)
        columns = [c[0] for c in want.description]
        got = queries.queries()[name](spark, SMALL).select(*columns).collect()
        assert sorted(map(tuple, got)) == sorted(want.fetchall()), name


def test_no_cut_of_the_input(spark):
    from tidelog.llm import queries

    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert queries.queries()["op3_shuffle_shards"](spark, SMALL).count() == n


# embeddings: numbers at the ends of the range, labels of any type, the bounds of an audit


def test_tiny_and_huge_vectors_and_text_labels(spark):
    rows = [(1, [1e-200, 1e-200], "a"), (2, [1.0, 1.0], "a"), (3, [1e200, 1e200], "a"), (4, [5e-324, 5e-324], "a")]
    rows += [(5, [1e300, -1e300], "a"), (6, [1e-300, -1.01e-300], "a"), (7, [1.0, 1.0], "b"), (8, [1e-320, 0.0], "b")]
    rows += [(9, [1.7e308, 1.7e308], "b"), (10, [0.0, -0.0], "b")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(map(tuple, hnsw.near_duplicates(df).collect()))
    assert got == [
        (1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 1, 5), (6, 1, 5), (7, 1, 7), (8, 0, 8), (9, 1, 7), (10, 0, 10)
    ]


def test_few_links_are_found_by_the_graph(monkeypatch):
    """Of 6,000 vectors with 60 links, a fixed number is answered by brute force, and the links come."""
    r = np.random.default_rng(12)
    x = r.normal(size=(6000, 24))
    x[:60] = x[60:120] + r.normal(scale=0.05, size=(60, 24))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    brute, real = [], hnsw._all_within
    monkeypatch.setattr(hnsw, "_all_within", lambda g, q, some, least: brute.append(len(some)) or real(g, q, some, least))
    q, v, beam = hnsw.audited(hnsw.Graph(x).build(), x, np.arange(len(x)), 0.93, audit=256)
    true = {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.93), strict=True) if a != b}
    got = {(a, b) for a, b in zip(q.tolist(), v.tolist(), strict=True) if a != b}
    assert sum(brute) == 256 and beam < 1500
    assert len(got & true) >= 0.99 * len(true) and not got - true
