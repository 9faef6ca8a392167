"""Connected components of a graph that is a DataFrame of links.

Alternating star contraction: every vertex points its larger neighbours, then its smaller
ones, at the least vertex it knows, until nothing changes. A vertex with very many links is
a long list of rows, never one group: the least neighbour comes from a partial aggregate and
a join that adaptive execution may split. Each round is written to the shared folder, and
works in as many tasks as its edges call for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import merged, staged

#: Bytes of stored edges for a task.
_PER_TASK = 1 << 20


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each vertex of ``links`` (``a, b``): the least vertex reachable.

    Vertices are longs that are not null; direction, repeats and self-links do not matter.
    """
    one_way = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, seen = staged(one_way.distinct(), "edges"), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = merged(large, _PER_TASK, edges)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(down.select("u", F.col("m").alias("v")))
        )
        edges = staged(merged(merged(small, _PER_TASK, edges).distinct(), _PER_TASK, edges), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
