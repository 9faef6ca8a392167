"""Streams that keep state: the newest value per key, running counters and histograms.

State is one row per key or per attribute set. Results of a micro-batch go to
``<folder>/updates/batch_id=N``; writing a batch again replaces it, so a replay after a
crash changes nothing. Every so many batches they are folded into a snapshot (see
``snapshots``), so what a reader opens does not grow with the age of a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.histogram import DEFAULT_BOUNDS, bucket_index
from tidelog.operators.compaction import latest_per_key
from tidelog.streaming.snapshots import FOLD_EVERY, Updates

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: Spark's state store that keeps state on disk instead of the heap.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"
#: Stores for state of one row for each attribute set or partition. Each is committed in every batch, rows or not.
FEW_STORES = 8


@contextmanager
def rocksdb_state(spark: SparkSession, stores: int | None = None):
    """Queries started inside keep their state in RocksDB, in at most ``stores`` stores.

    By default, and at most, these are as many as the session's shuffle partitions. A query that
    goes on from a checkpoint keeps the number that it began with.
    """
    wanted = {_PROVIDER: _ROCKSDB}
    if stores is not None:
        wanted[_PARTITIONS] = str(min(stores, int(spark.conf.get(_PARTITIONS))))
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _start_updates(
    updates: DataFrame, name: str, table: Updates, folder: str, drain: bool, stores: int | None = None
) -> StreamingQuery:
    writer = (
        updates.writeStream.outputMode("update")
        .foreachBatch(table.store)
        .queryName(name)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    with rocksdb_state(updates.sparkSession, stores):
        return (writer.trigger(availableNow=True) if drain else writer).start()


def _last_of(by: list[str], order: str):
    """Of several rows of a key, the one with the largest ``order``."""

    def fold(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in by]
        return rows.groupBy(*by).agg(F.max_by(F.struct(*values), order).alias("_last")).select(*by, "_last.*")

    return fold


def newest_updates(folder: str, every: int = FOLD_EVERY) -> Updates:
    """What ``follow_latest`` writes: records of a key, of which the largest offset counts."""
    return Updates(f"{folder}/updates", _last_of(["rkey", "topic"], "roff"), every)


def follow_latest(
    stream: DataFrame, folder: str, name: str, drain: bool = False, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Keep the newest record of every key of a compacted log, across batches."""
    return _start_updates(latest_per_key(stream), name, newest_updates(folder, fold_every), folder, drain)


def latest_view(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The table ``follow_latest`` maintains: updates of a key overtaken by later ones drop."""
    columns = {f.name: f for f in schema.fields}
    stored = T.StructType([columns[c] for c in ("topic", "rkey", "rvalue", "roff")])
    return newest_updates(folder).read(spark, stored)


def total_updates(folder: str, by: list[str], every: int = FOLD_EVERY) -> Updates:
    """What ``count_running`` writes: totals of an attribute set, of which the last batch's counts."""
    return Updates(f"{folder}/updates", _last_of(by, "batch_id"), every)


def count_running(
    stream: DataFrame,
    by: list[str],
    measures: dict[str, Column],
    folder: str,
    name: str,
    drain: bool = False,
    fold_every: int = FOLD_EVERY,
    stores: int = FEW_STORES,
) -> StreamingQuery:
    """Cumulative counters: every changed attribute set with its total so far.

    ``stores`` is how many state stores share the attribute sets; raise it for millions of sets.
    """
    totals = stream.groupBy(*by).agg(*[m.alias(n) for n, m in measures.items()])
    return _start_updates(totals, name, total_updates(folder, by, fold_every), folder, drain, stores)


def running_totals(spark: SparkSession, folder: str, schema: str, by: list[str]) -> DataFrame:
    """The last total of each attribute set written by ``count_running``."""
    return total_updates(folder, by).read(spark, schema)


# A histogram of microseconds: how many, their sum, the smallest, the largest, how many in each bucket.
_HISTOGRAM = "num bigint, sum_us decimal(38,0), min_us bigint, max_us bigint, bucket_counts array<bigint>"


def histogram_running(
    stream: DataFrame,
    by: list[str],
    value_us: str,
    folder: str,
    name: str,
    bounds: Sequence[float] = DEFAULT_BOUNDS,
    drain: bool = False,
    fold_every: int = FOLD_EVERY,
    stores: int = FEW_STORES,
) -> StreamingQuery:
    """Cumulative explicit-bucket histograms: every changed attribute set with its histogram so far.

    State is one row for each attribute set, in ``stores`` state stores. ``merge_histograms`` adds up those of several jobs.
    """
    value = F.col(value_us)
    buckets = [F.count(F.when(F.col("_bucket") == k, 1)).alias(f"_b{k}") for k in range(len(bounds) + 1)]
    counted = (
        stream.where(value.isNotNull())
        .withColumn("_bucket", bucket_index(value_us, bounds))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("num"),
            F.sum(value.cast("decimal(19,0)")).cast("decimal(38,0)").alias("sum_us"),
            F.min(value).alias("min_us"),
            F.max(value).alias("max_us"),
            *buckets,
        )
    )
    bucket_counts = F.array(*[F.col(f"_b{k}") for k in range(len(bounds) + 1)]).alias("bucket_counts")
    rows = counted.select(*by, "num", "sum_us", "min_us", "max_us", bucket_counts)
    return _start_updates(rows, name, total_updates(folder, by, fold_every), folder, drain, stores)


def running_histograms(spark: SparkSession, folder: str, by_schema: str, by: list[str]) -> DataFrame:
    """The histograms that ``histogram_running`` has counted so far."""
    return total_updates(folder, by).read(spark, f"{by_schema}, {_HISTOGRAM}")


def merge_histograms(histograms: DataFrame, by: list[str], bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """Histograms of the same bounds added up by fewer attributes."""
    return histograms.groupBy(*by).agg(
        F.sum("num").alias("num"),
        F.sum("sum_us").cast("decimal(38,0)").alias("sum_us"),
        F.min("min_us").alias("min_us"),
        F.max("max_us").alias("max_us"),
        F.array(*[F.sum(F.get("bucket_counts", F.lit(k))) for k in range(len(bounds) + 1)]).alias("bucket_counts"),
    )


def delta_updates(folder: str, by: list[str], every: int = FOLD_EVERY) -> Updates:
    """What ``count_deltas`` writes: numbers to be added up."""

    def fold(rows: DataFrame) -> DataFrame:
        numbers = [c for c in rows.columns if c not in (*by, "batch_id")]
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        added = [F.sum(c).cast(kinds[c]).alias(c) for c in numbers]
        return rows.groupBy(*by).agg(*added, F.max("batch_id").alias("batch_id"))

    return Updates(f"{folder}/updates", fold, every)


def count_deltas(
    stream: DataFrame,
    by: list[str],
    measures: dict[str, Column],
    folder: str,
    name: str,
    drain: bool = False,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Delta counters: what each micro-batch added. Needs no state."""
    table = delta_updates(folder, by, fold_every)

    def store(batch: DataFrame, batch_id: int) -> None:
        table.store(batch.groupBy(*by).agg(*[m.alias(n) for n, m in measures.items()]), batch_id)

    writer = (
        stream.writeStream.foreachBatch(store)
        .queryName(name)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def delta_totals(spark: SparkSession, folder: str, schema: str, by: list[str]) -> DataFrame:
    """What the deltas of ``count_deltas`` add up to."""
    return delta_updates(folder, by).read(spark, schema)


def count_buckets(
    stream: DataFrame,
    by: list[str],
    value_us: str,
    folder: str,
    name: str,
    bounds: Sequence[float] = DEFAULT_BOUNDS,
    drain: bool = False,
) -> StreamingQuery:
    """Explicit-bucket histograms: what each micro-batch added to each bucket."""
    valued = stream.where(F.col(value_us).isNotNull()).withColumn("bucket", bucket_index(value_us, bounds))
    measures = {"bucket_count": F.count(F.lit(1)), "sum_us": F.sum(value_us)}
    return count_deltas(valued, [*by, "bucket"], measures, folder, name, drain)


def bucket_totals(spark: SparkSession, folder: str, by_schema: str, by: list[str]) -> DataFrame:
    """The histograms that ``count_buckets`` has counted so far, one row per bucket in use."""
    schema = f"{by_schema}, bucket int, bucket_count bigint, sum_us bigint"
    return delta_totals(spark, folder, schema, [*by, "bucket"])


def dedup_stream(stream: DataFrame, event_time: str, horizon: str) -> DataFrame:
    """Drop records delivered again within ``horizon`` of event time."""
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(
        ["topic", "part", "roff"]
    )
