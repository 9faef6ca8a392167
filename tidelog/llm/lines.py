"""Line dedup by overlapping three-line windows, with DataFrame functions only.

A window is ``size`` consecutive lines of one text (lines are what newlines separate). A
window that occurs before, in the order of (doc_id, content, line number), is a later
occurrence; the lines that later occurrences cover, overlaps merged, are removed. Windows
are judged on the input, not on what is left.

Windows are counted by a 128-bit hash with partial aggregation, so a window that a third of
all texts hold costs a row per task. Only windows that repeat travel back to their texts.

* Null texts and texts of fewer lines than a window come back unchanged.
* Rows of the same id and text are one text to the counting: they are treated alike, and do
  not remove each other's lines.
* Null ids count as after all others.
* Other columns stay; of the names below, inputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import text_identity, text_key

OUTPUT = ("n_lines", "n_lines_removed")


def _windows(lines: Column, size: int) -> Column:
    """128-bit hashes of all windows of an array of lines."""

    def one(i: Column) -> Column:
        window = F.slice(lines, i, F.lit(size))
        return F.struct(F.xxhash64(F.lit(1), window).alias("h1"), F.xxhash64(F.lit(2), window).alias("h2"))

    count = F.size(lines) - (size - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), one))


def dedup_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """All rows of ``df``, ``text`` without lines of later windows, plus ``n_lines`` and ``n_lines_removed``."""
    own = [c for c in df.columns if c not in OUTPUT]
    rows = df.select(
        F.struct(*own).alias("row"),
        text_identity(id_column, text).alias("doc"),
        F.split(text, "\n", -1).alias("lines"),
    )
    found = rows.select("doc", F.posexplode(_windows(F.col("lines"), size)).alias("at", "window"))
    places = F.struct("doc", "at")
    repeated = (
        found.groupBy("window")
        .agg(F.min(places).alias("first"), F.max(places).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("window", "first")
    )
    later = (
        found.join(repeated, "window")
        .where(F.struct("doc", "at") != F.col("first"))
        .groupBy(text_key(F.col("doc")).alias("key"))
        .agg(F.collect_set("at").alias("starts"))
    )
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + size - 1))))
    kept = F.when(
        F.col("covered").isNotNull(),
        F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "covered"),
                lambda i: F.get("lines", i),
            ),
            "\n",
        ),
    ).otherwise(F.col(f"row.`{text}`"))
    return (
        rows.withColumn("key", text_key(F.col("doc")))
        .join(later.select("key", covered.alias("covered")), "key", "left")
        .select(
            *[kept.alias(c) if c == text else F.col(f"row.`{c}`") for c in own],
            F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
            F.coalesce(F.size("covered"), F.lit(0)).cast("bigint").alias("n_lines_removed"),
        )
    )
