"""Benchmark decontamination by n-gram windows, with DataFrame functions only.

Words are runs of ASCII letters and digits and of everything beyond ASCII; A-Z count as a-z.
A window is ``size`` consecutive words of a benchmark item; an item of fewer words, but not
none, is one window. A document word inside any occurrence of a window is hit, and a
document is contaminated when it has a hit and ``share`` * hits reaches its words.

Document windows are hashed as arrays and exploded into a join with the hashes of the
benchmark windows; what matches is then compared word by word. The hashes go out as a
broadcast if there are few enough of them, and are joined by a shuffle if not. Hashing uses
Unicode lower case, which is quick and puts equal words together; the comparison folds
exactly A-Z.

Null texts and texts without words have no hits; null benchmark texts have no windows. Rows
of the same id and text are treated alike. Null ids are kept. Other columns stay; of the
names in ``OUTPUT``, inputs are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.joins import bounded
from tidelog.llm.common import staged, text_identity, text_key

OUTPUT = ("n_words", "n_hit", "n_items", "items", "contaminated")
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Distinct benchmark windows up to which their hashes are broadcast (16 bytes each).
BROADCAST_WINDOWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded_words(text: str) -> Column:
    """Words in Unicode lower case; the capital sigma, whose lower case depends on its place, first."""
    low = F.lower(F.replace(F.col(text), F.lit("Σ"), F.lit("σ")))
    return F.filter(F.split(low, SEPARATORS, -1), lambda w: w != "")


def _hashes(words: Column, size: int) -> Column:
    count = F.size(words) - (size - 1)
    return F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, F.lit(size)))
        ),
    )


def _exact(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """``item, size, hash, gram`` for each distinct window of each item."""
    words = benchmark.select(
        F.col(item).alias("item"), _exact(text).alias("exact"), folded_words(text).alias("words")
    ).where(F.size("exact") > 0)
    own = F.least(F.size("exact"), F.lit(size))
    windows = F.transform(
        F.sequence(F.lit(1), F.size("exact") - own + 1),
        lambda i: F.struct(
            own.alias("size"),
            F.xxhash64(F.slice("words", i, own)).alias("hash"),
            F.concat_ws(" ", F.slice("exact", i, own)).alias("gram"),
        ),
    )
    return words.select("item", F.inline(windows)).distinct()


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = 13,
    share: int = 20,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """All rows of ``df`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids as
    strings), ``hit_words`` (sorted numbers of the hit words) and ``contaminated``."""
    own = [c for c in df.columns if c not in (*OUTPUT, "hit_words")]
    windows = staged(benchmark_windows(benchmark, item, item_text, size), "windows")
    sizes = windows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``size`` rows
    few = lambda frame: bounded(frame, sum(r["n"] for r in sizes), broadcast_windows)
    rows = df.select(
        F.struct(*own).alias("row"),
        text_key(text_identity(id_column, text)).alias("key"),
        F.col(text).alias("_text"),
        folded_words(text).alias("words"),
    )
    # Where hashes are broadcast only hits move, with their texts. A shuffle moves every window,
    # so there texts stay behind and those with hits are joined back.
    sent = sum(r["n"] for r in sizes) <= broadcast_windows
    with_text = ["key", "_text"] if sent else ["key"]

    def started(size: int) -> DataFrame:
        starts = (
            rows.select(*with_text, F.posexplode(_hashes(F.col("words"), size)).alias("at", "hash"))
            .join(few(windows.where(F.col("size") == size).select("hash").distinct()), "hash")
            .groupBy(*with_text)
            .agg(F.collect_set("at").alias("starts"))
        )
        return starts if sent else starts.join(rows.select("key", "_text"), "key")

    found = [
        started(r["size"])
        .select("key", F.lit(r["size"]).alias("size"), "starts", _exact("_text").alias("exact"))
        .select(
            "key",
            "size",
            F.explode(
                F.transform(
                    "starts",
                    lambda at: F.struct(
                        at.alias("at"), F.concat_ws(" ", F.slice("exact", at + 1, F.col("size"))).alias("gram")
                    ),
                )
            ).alias("hit"),
        )
        for r in sizes
    ]
    if found:
        hits = reduce(DataFrame.unionAll, found).select("key", "size", "hit.at", "hit.gram")
    else:
        hits = rows.select("key", F.lit(0).alias("size"), F.lit(0).alias("at"), F.lit("").alias("gram")).where("false")
    matched = hits.join(few(windows.select("gram", "size", "item")), ["gram", "size"])
    covered = F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)
    by_text = (
        matched.groupBy("key")
        .agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_set(covered)))).alias("hit_words"),
            F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"),
        )
    )
    n_words = F.coalesce(F.size("words"), F.lit(0)).cast("bigint")
    n_hit = F.coalesce(F.size("hit_words"), F.lit(0)).cast("bigint")
    return (
        rows.select("row", "key", n_words.alias("n_words"))
        .join(by_text, "key", "left")
        .select(
            *[F.col(f"row.`{c}`") for c in own],
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
            ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def remove_documents(found: DataFrame) -> DataFrame:
    """Rows that are not contaminated."""
    return found.where(~F.col("contaminated"))


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Rows with the hit words taken out of ``text``, each with what follows it up to the next word.

    What stands before a run of hit words stays, also at the end of a text; a text of hit words
    only keeps what stands before the first. Texts without hits stay as they are.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    gaps = F.split(F.col(text), WORD, -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(words) - 1), F.col("hit_words"))
    rest = F.array_join(F.transform(kept, lambda i: F.concat(F.get(words, i), F.get(gaps, i + 1))), "")
    return found.withColumn(text, F.when(F.size("hit_words") > 0, F.concat(F.get(gaps, F.lit(0)), rest)).otherwise(F.col(text)))
