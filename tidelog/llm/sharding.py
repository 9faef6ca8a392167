"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Law: ``rows``. Shard sizes differ by one row at most, and every arrangement of the rows is
(up to the random generator) equally likely:

1. *permute locally*: the rows of each input partition are put in random order and
   numbered, in the partition itself;
2. the matrix says how many rows each partition gives to each shard. Its rows are drawn one
   after the other from a multivariate hypergeometric distribution over the places still
   free, which is how many would go there in a uniform shuffle of everything;
3. *exchange*: a row goes to the shard whose range of the matrix row holds its number;
4. *permute again*: the rows of a shard get slots in the order of a second random number.

The driver sees one count per input partition and draws partitions x shards numbers, never
rows. A shard is ordered in pieces of bounded expected size, so no task sorts a whole
shard, and the input may hold any number of equal rows, ids or null ids: rows are told apart
by their place in a staged copy. Rows are not grouped: equal texts may go to different
shards, as a uniform shuffle of exact sizes demands.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import staged

#: Rows that are put in order together inside a shard, on average.
PIECE_ROWS = 250_000


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows each source gives to each shard, in a uniform shuffle of exact sizes.

    Row sums are ``sizes``; column sums are the shard sizes, which differ by one at most.
    """
    total = sum(sizes)
    free = np.full(shards, total // shards, dtype=np.int64)
    free[: total % shards] += 1
    random = np.random.default_rng(seed)
    matrix = np.zeros((len(sizes), shards), dtype=np.int64)
    for k, size in enumerate(sizes):
        left = size
        places = int(free.sum())
        # One shard after the other: of the places not looked at yet, how many does it have?
        for s in range(shards):
            places -= int(free[s])
            if left == 0:
                break
            drawn = left if places == 0 else _drawn(random, int(free[s]), places, left)
            matrix[k, s] = drawn
            left -= drawn
        free -= matrix[k]
    return matrix


def _drawn(random: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric number; the generator takes populations below 1e9."""
    if good == 0:
        return 0
    if good + bad < 1_000_000_000:
        return int(random.hypergeometric(good, bad, sample))
    return _by_ratios(random, good, bad, sample)


def _by_ratios(random: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric number of any population, by inversion of its distribution.

    Neighbouring probabilities have simple ratios. What lies further from the mean than 12
    standard deviations and 64 is less likely than a double can tell from nothing.
    """
    total = good + bad
    mean = sample * good // total
    spread = (sample * (good / total) * (bad / total) * ((total - sample) / (total - 1))) ** 0.5
    reach = int(12 * spread) + 64
    low = max(sample - bad, 0, mean - reach)
    high = min(good, sample, mean + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) / (k + 1)) + np.log((sample - k) / (bad - sample + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    below = np.cumsum(np.exp(logs - logs.max()))
    return min(low + int(np.searchsorted(below, random.random() * below[-1], side="right")), high)


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 7, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """All rows of ``df`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each).

    Columns of ``df`` named ``shard`` or ``slot`` are replaced. An empty input gives no rows.
    The same session settings, input files and seed give the same result.
    """
    spark = df.sparkSession
    own = [c for c in df.columns if c not in ("shard", "slot")]
    data = df.select(F.struct(*own).alias("row")) if own else df.select(F.struct(F.lit(0).alias("_")).alias("row"))
    local = staged(
        data.withColumn("rid", F.monotonically_increasing_id())
        .withColumn("source", F.spark_partition_id())
        .sortWithinPartitions(F.xxhash64(F.lit(seed), "rid"))
        .withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "shuffle",
    )
    counts = sorted((r["source"], r["n"]) for r in local.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect())
    sizes = [n for _, n in counts]
    matrix = communication_matrix(sizes, shards, seed)
    ends = matrix.cumsum(axis=1)
    given = spark.createDataFrame(
        [(source, row.tolist()) for (source, _), row in zip(counts, ends, strict=True)],
        "source int, ends array<bigint>",
    )
    pieces = max(1, -(-sum(sizes) // (shards * piece_rows)))
    placed = (
        local.join(given, "source")
        .withColumn("shard", F.expr("cast(size(filter(ends, e -> e <= nth)) as int)"))
        .withColumn("key", F.xxhash64(F.lit(seed + 1), "rid"))
        .withColumn("piece", F.pmod(F.shiftrightunsigned("key", 20), F.lit(pieces)).cast("int"))
        .drop("ends", "source", "nth")
    )
    cells = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_piece = Window.partitionBy("shard", "piece").orderBy("key", "rid")
    return (
        placed.withColumn("rank", F.row_number().over(in_piece) - 1)
        .join(offsets, ["shard", "piece"])
        .select(*[F.col(f"row.`{c}`") for c in own], "shard", (F.col("offset") + F.col("rank")).alias("slot"))
    )
