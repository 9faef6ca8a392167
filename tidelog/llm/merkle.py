"""Merkle dataset manifest: a digest for each row, subroots by group, one root, and proofs.

A *leaf* is the digest of a row's fields (``leaf_digest``). The leaves of a group ascend by
id; while several nodes remain, every two consecutive ones become the digest of both, a
last single one the digest of itself alone. What remains is the group's *subroot* (of one
row, its leaf). The subroots, in order of their groups, give the *root* in the same way.

A tree is cut into *superblocks* of ``2**height`` consecutive nodes:

1. rows are numbered by sorted ranges, so no task holds a group;
2. each superblock is reduced to one node. These are the nodes of the next *tier*, again cut
   into superblocks, until a group has one node left; a tier is a thousandth of the one below;
3. downwards, the nodes of a tier are *cogrouped* by superblock with the outer nodes that it
   needs: the siblings on its way to the root. One function call per superblock finishes the
   local reduction, joins each node's own siblings with the outer ones and, at the leaves,
   folds every leaf (or what is claimed to be it) up to a root that is compared with the real
   one. So a proof never moves but as one outer path for each superblock.

Groups ascend with null first, bytewise; ids with nulls first; rows of equal ids by leaf, and
equal rows in any order, which does not show. Empty and very long texts are digested where
they are read; only digests move. No rows give no rows, and no root. Other columns are not
carried, so their names do not matter.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import partitions, staged

#: Superblocks have ``2**HEIGHT`` nodes.
HEIGHT = 10
NODES = "tree bigint, idx bigint, n bigint, digest string"
OUTER = "tree bigint, idx bigint, path array<string>, root string"


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: ``-`` for a null, else UTF-8 byte count, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to, in built-in functions.

    A step of a proof is ``L`` or ``R`` with the sibling on that side, or empty for none.
    """

    def step(digest: Column, s: Column) -> Column:
        side, sibling = F.substring(s, 1, 1), F.substring(s, 2, 64)
        both = F.when(side == "L", F.concat(sibling, digest)).when(side == "R", F.concat(digest, sibling))
        return F.sha2(F.coalesce(both, digest), 256)

    return F.aggregate(proof, leaf, step)


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _fold(digest: str, path: list[str]) -> str:
    for step in path:
        digest = _digest(step[1:] + digest if step[:1] == "L" else digest + step[1:])
    return digest


def _levels(n: int, height: int) -> int:
    """By how many levels a superblock of a tree of ``n`` nodes is reduced."""
    return min(height, (n - 1).bit_length())


def _grown(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock level by level, the given ones first."""
    tree = [digests]
    for _ in range(levels):
        below = tree[-1]
        tree.append([_digest("".join(below[k : k + 2])) for k in range(0, len(below), 2)])
    return tree


def _siblings(tree: list[list[str]], k: int) -> list[str]:
    """The steps from node ``k`` of a superblock to its top."""
    steps = []
    for level in tree[:-1]:
        other = k ^ 1
        steps.append(("LR"[other > k] + level[other]) if other < len(level) else "")
        k >>= 1
    return steps


def in_order(df: DataFrame, *order: Column | str) -> tuple[DataFrame, int]:
    """``df`` with ``nth``, the place of a row in the order of all (from 0), and how many there are.

    Sorted ranges are written, counted, and offset by the sizes of the ranges before: the
    driver sees one count for each shuffle partition. The order must not leave many rows equal.
    """
    spark = df.sparkSession
    cut = staged(
        df.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("piece", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "ordered",
    )
    starts, total = [], 0
    for r in sorted(cut.groupBy("piece").agg(F.count(F.lit(1)).alias("rows")).collect()):
        starts.append((r["piece"], total))
        total += r["rows"]
    first = spark.createDataFrame(starts, "piece int, first bigint")
    return cut.join(first, "piece").withColumn("nth", F.col("first") + F.col("place")).drop("piece", "place", "first"), total


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("idx", height))


def _climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The tiers of all trees, from ``nodes`` to one node for each tree."""

    def reduce(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("idx")
        n = int(part["n"].iloc[0])
        levels = _levels(n, height)
        top = _grown(part["digest"].tolist(), levels)[-1][0]
        return pd.DataFrame(
            {"tree": part["tree"].iloc[:1], "idx": part["block"].iloc[:1], "n": [-(-n >> levels)], "digest": [top]}
        )

    tiers = [nodes]
    while len(tiers) == 1 or tiers[-1].agg(F.max("n")).first()[0] not in (None, 1):
        blocks = _blocks(tiers[-1].select("tree", "idx", "n", "digest"), height)
        tiers.append(staged(blocks.groupBy("tree", "block").applyInPandas(reduce, NODES), "tier"))
    return tiers


def _descend(tiers: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """The path to the root of each node of the lowest tier, given those of the highest."""

    def extend(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("idx")
        tree = _grown(part["digest"].tolist(), _levels(int(part["n"].iloc[0]), height))
        path, root = list(above["path"].iloc[0]), above["root"].iloc[0]
        return pd.DataFrame(
            {
                "tree": part["tree"],
                "idx": part["idx"],
                "path": [_siblings(tree, k) + path for k in range(len(part))],
                "root": root,
            }
        )

    for tier in reversed(tiers[:-1]):
        nodes = _blocks(tier, height).groupBy("tree", "block")
        outer = staged(
            nodes.cogroup(outer.withColumnRenamed("idx", "block").groupBy("tree", "block")).applyInPandas(extend, OUTER),
            "outer",
        )
    return outer


def manifest(
    df: DataFrame,
    leaf: Column,
    claimed: Column | None = None,
    id_column: str = "doc_id",
    group: str = "lang",
    proofs: bool = False,
    height: int = HEIGHT,
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` for each row.

    ``claimed`` is a digest to be checked in the leaf's place; where it is null the leaf
    itself is folded. ``proof_sha256`` is the digest of the proof's siblings one after the other;
    ``proofs`` adds the steps of the ``proof``, for ``fold``.
    """
    kind = df.schema[id_column].dataType
    digests = staged(
        df.select(
            F.col(id_column).alias("id"),
            F.col(group).alias("group"),
            leaf.alias("digest"),
            (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    ordered, _ = in_order(digests, "group", "id", "digest", "row")
    trees = ordered.groupBy("group").agg(F.min("nth").alias("tree"), F.count(F.lit(1)).alias("n"))
    same = F.col("o.group").eqNullSafe(F.col("t.group"))
    leaves = staged(
        ordered.alias("o")
        .join(trees.alias("t"), same)
        # As text, since pandas would make floating-point numbers of ids with nulls.
        .select("tree", (F.col("nth") - F.col("tree")).alias("idx"), "n", "digest", F.col("id").cast("string").alias("id"), "claimed"),
        "leaves",
    )
    tiers = _climb(leaves, height)

    # The tree of the subroots, which stand in the order in which the groups begin.
    subroots, groups = in_order(tiers[-1].select(F.col("tree").alias("of"), "digest"), "of")
    subroots = staged(
        subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("nth").alias("idx"), F.lit(groups).cast("bigint").alias("n"), "digest", "of"),
        "subroots",
    )
    upper = _climb(subroots, height)
    none = F.array().cast("array<string>")
    top = upper[-1].select("tree", "idx", none.alias("path"), F.col("digest").alias("root"))
    paths = _descend(upper, top, height).select("idx", "path", "root")
    outer = subroots.select("idx", F.col("of").alias("tree"), F.col("digest").alias("subroot")).join(paths, "idx")
    known = outer.select("tree", "subroot")
    outer = outer.select("tree", F.lit(0).cast("bigint").alias("idx"), "path", "root")
    outer = _descend(tiers[1:], outer, height).join(known, "tree")

    def prove(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("idx")
        digests = part["digest"].tolist()
        tree = _grown(digests, _levels(int(part["n"].iloc[0]), height))
        path, root = list(above["path"].iloc[0]), above["root"].iloc[0]
        steps = [_siblings(tree, k) + path for k in range(len(digests))]
        folded = [
            _fold(d if c is None else c, s) for d, c, s in zip(digests, part["claimed"].tolist(), steps, strict=True)
        ]
        out = {
            "id": part["id"],
            "leaf": digests,
            "subroot": above["subroot"].iloc[0],
            "root": root,
            "proof_sha256": [_digest("".join(x[1:] for x in s)) for s in steps],
            "folded_root": folded,
            "verified": [f == root for f in folded],
        }
        return pd.DataFrame(out | ({"proof": steps} if proofs else {}))

    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    proved = (
        _blocks(leaves, height)
        .groupBy("tree", "block")
        .cogroup(outer.withColumnRenamed("idx", "block").groupBy("tree", "block"))
        .applyInPandas(prove, schema + (", proof array<string>" if proofs else ""))
    )
    return proved.withColumn("id", F.col("id").cast(kind))
