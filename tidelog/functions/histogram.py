"""Explicit-bucket histograms as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default bucket bounds, in seconds.
DEFAULT_BOUNDS = (0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)


def half_octave_bounds(low: int = -16, high: int = 34) -> tuple[float, ...]:
    """Bounds at every half power of two; the default range is 2^-8 to 2^17 seconds."""
    return tuple(2.0 ** (i / 2) for i in range(low, high + 1))


def bucket_index(value_us: str, bounds: Sequence[float]) -> Column:
    """Bucket number of a column in microseconds; upper bounds (seconds) are inclusive.

    A balanced tree of comparisons: it stays inside generated code and costs log2(n)
    comparisons per row.
    """

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        # value <= bound in seconds, compared as whole microseconds
        limit = int(Decimal(str(bounds[mid])) * 1_000_000)
        return f"if(`{value_us}` <= {limit}L, {tree(lo, mid)}, {tree(mid + 1, hi)})"

    return F.expr(tree(0, len(bounds)))


def histogram_buckets(
    df: DataFrame, attrs: Sequence[str], value_us: str, bounds: Sequence[float] = DEFAULT_BOUNDS
) -> DataFrame:
    """One row per attribute set and non-empty bucket.

    Columns: the attributes, ``bucket``, ``bucket_count``, ``sum_us``, ``min_us``,
    ``max_us``. The sum is kept as seconds and a remainder while rows are added, so that
    it does not overflow a long.
    """
    value = F.col(value_us)
    return (
        df.where(value.isNotNull())
        .withColumn("bucket", bucket_index(value_us, bounds))
        .groupBy(*attrs, "bucket")
        .agg(
            F.count(F.lit(1)).alias("bucket_count"),
            F.sum(F.expr(f"`{value_us}` div 1000000")).alias("_s"),
            F.sum(F.expr(f"`{value_us}` % 1000000")).alias("_us"),
            F.min(value).alias("min_us"),
            F.max(value).alias("max_us"),
        )
        .withColumn(
            "sum_us",
            F.col("_s").cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
            + F.col("_us"),
        )
        .drop("_s", "_us")
    )


def histogram(
    df: DataFrame, attrs: Sequence[str], value_us: str, bounds: Sequence[float] = DEFAULT_BOUNDS
) -> DataFrame:
    """One row per attribute set: ``count, sum_us, min_us, max_us, bounds, bucket_counts``.

    The rows are first counted per bucket, so what is gathered into an array is at most
    one entry per bucket.
    """
    buckets = histogram_buckets(df, attrs, value_us, bounds)
    by_bucket = F.map_from_entries(F.collect_list(F.struct("bucket", "bucket_count")))
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(len(bounds))),
        lambda i: F.coalesce(F.element_at(F.col("_by_bucket"), i), F.lit(0).cast("bigint")),
    )
    return (
        buckets.groupBy(*attrs)
        .agg(
            F.sum("bucket_count").alias("count"),
            F.sum("sum_us").cast("decimal(38,0)").alias("sum_us"),
            F.min("min_us").alias("min_us"),
            F.max("max_us").alias("max_us"),
            by_bucket.alias("_by_bucket"),
        )
        .withColumn("bounds", F.expr(f"array({', '.join(f'{float(b)!r}D' for b in bounds)})"))
        .withColumn("bucket_counts", counts)
        .drop("_by_bucket")
    )


def histogram_summary(hist: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Printable summary of a histogram.

    ``midrange_us`` is (min + max) / 2; ``mean_us`` is the true mean. ``labels`` lists the
    attributes as ``(key:value)``, in name order.
    """
    labels = F.concat_ws(
        "", *[F.concat(F.lit(f"({a}:"), F.col(a).cast("string"), F.lit(")")) for a in sorted(attrs)]
    )
    return hist.select(
        labels.alias("labels"),
        "min_us",
        "max_us",
        ((F.col("min_us") + F.col("max_us")) / F.lit(2.0)).alias("midrange_us"),
        (F.col("sum_us").cast("double") / F.col("count")).alias("mean_us"),
        "sum_us",
        "count",
        "bounds",
        "bucket_counts",
    )
