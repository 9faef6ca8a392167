"""Manifest digests and proofs against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import merkle

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, tree int, digest string, block string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    i, text, source, lang, n = row
    n = n if n is None else n + more
    parts = [None if x is None else str(x) for x in (i, source, lang, n, text)]
    return h("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def tree_of(leaves):
    """The root, and for each leaf its siblings with their sides (0: alone)."""
    level, proofs, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, p in enumerate(at):
            other = p ^ 1
            proofs[k].append((-1 if other < p else 1, level[other]) if other < len(level) else (0, ""))
            at[k] = p // 2
        level = [h("".join(level[k : k + 2])) for k in range(0, len(level), 2)]
    return level[0], proofs


def folded(digest, proof):
    for side, sibling in proof:
        digest = h(sibling + digest if side < 0 else digest + sibling)
    return digest


def brute(rows):
    langs = sorted({r[3] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[3] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for x in langs]
    trees = [tree_of([leaf_of(r) for r in g]) for g in groups]
    root, above = tree_of([t[0] for t in trees])
    out = []
    for group, (subroot, proofs), upper in zip(groups, trees, above, strict=True):
        for row, proof in zip(group, proofs, strict=True):
            path = proof + upper
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            end = folded(leaf_of(row, 1 if bad else 0), path)
            out.append((row[0], leaf_of(row), subroot, root, h("".join(s for _, s in path)), end, end == root))
    return sorted(out, key=repr)


def proved(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], SCHEMA).repartition(3)
    fields = lambda n: [F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")]
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_digest(*fields(F.col("n_chars") + 1)))
    return merkle.manifest(df, merkle.leaf_digest(*fields(F.col("n_chars"))), claimed, **options)


COLUMNS = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def corpus_rows(corpus):
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, ("en", "de", None, "é", "Z")[i * i % 5], None if i % 6 == 0 else len(t or "")) for i, t in corpus]
    rows += [rows[0], rows[0], rows[1], (None, "a", None, None, 3), (None, "b", "s", "en", 3), (None, None, None, None, None)]
    rows += [(-5, "x", "s", "en", 1), (1 << 62, "y", "s", "en", 1), ((1 << 62) + 1, "y", "s", "en", 1), (9, "lone", "s", "only", 4)]
    return rows


@pytest.mark.parametrize("height", [1, 3, 10])
def test_manifest(spark, corpus, height):
    rows = corpus_rows(corpus)
    want = brute(rows)
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)
    got = proved(spark, rows, height=height).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9])
def test_sizes(spark, n):
    rows = [(k, "t", "s", "en", 1) for k in range(n)]
    assert sorted(map(tuple, proved(spark, rows, height=2).select(COLUMNS).collect()), key=repr) == brute(rows)


def test_proofs_fold_in_built_in_functions(spark, corpus):
    out = proved(spark, corpus_rows(corpus), height=2, proofs=True)
    ends = out.select("root", merkle.fold(F.col("leaf"), F.col("proof")).alias("end"), merkle.fold(F.lit("0"), F.col("proof")).alias("wrong"))
    assert all(r.end == r.root != r.wrong for r in ends.collect())


def test_none(spark):
    assert proved(spark, []).collect() == []
