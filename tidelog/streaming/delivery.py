"""Consuming a stream at least once or at most once.

Each job owns a folder: ``checkpoint``, ``results/batch_id=N`` (processed rows under
``failed=false``, dead letters under ``failed=true``) and ``commits/batch_id=N``. Put it in
storage that all executors share.

The commits are a ledger of intervals of offsets. It is folded as batches commit (see
``snapshots``): intervals that meet become one, so a snapshot has one row for each partition
and one more for each gap, however many batches there have been.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.processing import BatchProcessor, process_records
from tidelog.sources.shared import new_folder
from tidelog.streaming.snapshots import FOLD_EVERY, Updates

PARTITION = ["topic", "part"]
RANGES = "topic string, part int, first bigint, next bigint, commit bigint"


def merge_intervals(ranges: DataFrame) -> DataFrame:
    """Ranges of offsets that meet or overlap as one, with the largest commit among them.

    ``ranges`` is a folded ledger and the batches since, so a partition has as many rows as
    gaps and recent batches.
    """
    in_order = Window.partitionBy(*PARTITION).orderBy("first", "next")
    reached = F.max("next").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("first") > reached, F.lit(True)).cast("int")
    number = F.sum("_apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("_apart", apart)
        .withColumn("_number", number)
        .groupBy(*PARTITION, "_number")
        .agg(
            F.min("first").alias("first"),
            F.max("next").alias("next"),
            F.max("commit").alias("commit"),
            F.max("batch_id").alias("batch_id"),
        )
        .drop("_number")
    )


def ledger_updates(folder: str, every: int = FOLD_EVERY) -> Updates:
    """The ledger of a job: what each batch handled, folded into intervals."""
    return Updates(f"{folder}/commits", merge_intervals, every)


def _process_into(
    batch: DataFrame, batch_id: int, process: BatchProcessor, folder: str, ordered: bool
) -> str:
    """Run the caller's function over a micro-batch and store every row with its result.

    One write holds both sides, so the function runs once per attempt. Writing a batch
    again replaces what a crashed attempt left.
    """
    target = f"{folder}/results/batch_id={batch_id}"
    (
        process_records(batch, process, ordered)
        .withColumn("failed", F.col("error").isNotNull())
        .write.mode("overwrite")
        .partitionBy("failed")
        .parquet(target)
    )
    return target


def _ranges(batch: DataFrame, commit: Column) -> DataFrame:
    """Unbroken runs of offsets in a micro-batch: ``first``, ``next`` after the last, ``commit``."""
    in_order = Window.partitionBy(*PARTITION).orderBy("roff")
    return (
        batch.withColumn("_run", F.col("roff") - F.row_number().over(in_order))
        .groupBy(*PARTITION, "_run")
        .agg(F.min("roff").alias("first"), (F.max("roff") + 1).alias("next"), commit.alias("commit"))
        .drop("_run")
    )


#: Ranges of offsets (``topic, part, first, next``) of a batch, out of session, checkpoint and number.
Claims = Callable[[SparkSession, str, int], DataFrame]
#: Called after each batch with the session and the batch's number.
AfterBatch = Callable[[SparkSession, int], None]


def _start(
    stream: DataFrame, name: str, step, folder: str, drain: bool, after: AfterBatch | None = None
) -> StreamingQuery:
    def both(batch: DataFrame, batch_id: int) -> None:
        step(batch, batch_id)
        after(batch.sparkSession, batch_id)

    writer = (
        stream.writeStream.foreachBatch(step if after is None else both)
        .queryName(name)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def consume_at_least_once(
    stream: DataFrame,
    process: BatchProcessor,
    folder: str,
    name: str,
    drain: bool = False,
    ordered: bool = True,
    after: AfterBatch | None = None,
) -> StreamingQuery:
    """Process, then commit.

    The checkpoint marks a batch as done only after it was processed, so a crash brings it
    again. The commit of a range of offsets is the one after its last success, even if earlier
    rows failed; those go to the dead letters, not to a retry. ``drain`` stops once all
    records present at the start are processed. ``ordered`` handles a partition's rows in
    offset order in one task; without it they spread over tasks, for functions that do not
    depend on order. ``after`` is called after each batch, as to observe a ``readiness.Latch``.
    """

    return _start(stream, name, at_least_once_step(process, folder, ordered), folder, drain, after)


def at_least_once_step(process: BatchProcessor, folder: str, ordered: bool = True):
    """What ``consume_at_least_once`` does with each micro-batch."""
    ledger = ledger_updates(folder)

    def step(batch: DataFrame, batch_id: int) -> None:
        target = _process_into(batch, batch_id, process, folder, ordered)
        done = batch.sparkSession.read.schema(_stored(batch.schema)).parquet(target)
        ranges = _ranges(done, F.max(F.when(~F.col("failed"), F.col("roff"))) + 1)
        ledger.store(ranges, batch_id)

    return step


def consume_at_most_once(
    stream: DataFrame,
    process: BatchProcessor,
    folder: str,
    name: str,
    drain: bool = False,
    ordered: bool = True,
    after: AfterBatch | None = None,
    claims: Claims | None = None,
) -> StreamingQuery:
    """Commit, then process.

    The commits are the ledger: a batch enters it before its first record is processed, and
    one found there, even half written, is never processed again. A crash in between loses
    it. An error while committing ends the query before anything is processed.

    ``claims`` gives the ranges of offsets of a batch from what the stream's checkpoint says of
    it, as ``LogTable.ranges_of_batch`` does, so that a batch is read once; all records in
    them count as handled, also those that the stream filters out. Without it a batch is read
    for its offsets first, and once more to be processed.
    """
    ledger = ledger_updates(folder)

    def step(batch: DataFrame, batch_id: int) -> None:
        if claims is None:
            polled = _ranges(batch, F.max("roff") + 1)
        else:
            polled = claims(batch.sparkSession, f"{folder}/checkpoint", batch_id).select(*PARTITION, "first", "next", F.col("next").alias("commit"))
        try:
            ledger.store(polled, batch_id, mode="errorifexists")
        except AnalysisException as found:
            if found.getCondition() == "PATH_ALREADY_EXISTS":
                return
            raise
        _process_into(batch, batch_id, process, folder, ordered)

    return _start(stream, name, step, folder, drain, after)


def consume_groups(
    stream: DataFrame, process: BatchProcessor, folder: str, groups: list[str], drain: bool = False
) -> dict[str, StreamingQuery]:
    """Several groups over one log: each sees all of it and keeps its own position."""
    return {
        group: consume_at_least_once(stream, process, f"{folder}/{group}", f"{group}", drain)
        for group in groups
    }


def resume(stream: DataFrame, position: DataFrame) -> DataFrame:
    """What a group that starts anew reads: each partition from its committed position.

    A restart on the same checkpoint goes on after the last finished batch. A new run,
    with a folder of its own, starts from the commits of the old one instead, so under
    at-least-once delivery it gets the failed rows at or above them again. A partition
    without a commit is read from its start.

    The positions are those of now, written once, as every batch compares with them.
    """
    spark, kept = position.sparkSession, new_folder(position.sparkSession, "marks")
    position.select(*PARTITION, "position").write.parquet(kept)
    marks = spark.read.schema("topic string, part int, position bigint").parquet(kept)
    unread = F.col("position").isNull() | (F.col("roff") >= F.col("position"))
    return stream.join(marks, PARTITION, "left").where(unread).select(*stream.columns)


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType(
        schema.fields
        + [T.StructField("error", T.StringType()), T.StructField("failed", T.BooleanType())]
    )


def results(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Every row a job has processed, with ``error``, ``failed`` and ``batch_id``."""
    full = _stored(schema).add("batch_id", T.LongType())
    return spark.read.schema(full).parquet(f"{folder}/results")


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """What was handled per batch and partition: ranges of offsets and the commit in each.

    ``commit`` is null where nothing of a range succeeded.
    """
    return spark.read.schema(f"{RANGES}, batch_id bigint").parquet(f"{folder}/commits")


def intervals(spark: SparkSession, folder: str) -> DataFrame:
    """What a job has handled so far: one row for each unbroken range of offsets of a partition."""
    return ledger_updates(folder).read(spark, RANGES)


def positions(spark: SparkSession, folder: str, start: DataFrame | None = None) -> DataFrame:
    """``topic, part, position``: where the group stands now.

    A position is the last commit of the ranges handled without a gap, from offset 0 or from
    the ``position`` in ``start``. Batches that came out of offset order leave gaps; what lies
    above one has been handled but is not counted, so a new run reads it again and skips
    nothing. Failed rows count as handled.
    """
    ranges = intervals(spark, folder)
    if start is not None:
        ranges = ranges.join(start.select(*PARTITION, F.col("position").alias("_start")), PARTITION, "left")
    else:
        ranges = ranges.withColumn("_start", F.lit(None).cast("bigint"))
    in_order = Window.partitionBy(*PARTITION).orderBy("first", "next")
    reached = F.max("next").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.col("first") > F.coalesce(F.greatest(reached, F.coalesce("_start", F.lit(0))), F.lit(0))
    unbroken = ranges.withColumn("_gap", gap.cast("int")).withColumn(
        "_gaps", F.sum("_gap").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        unbroken.where("_gaps = 0")
        .groupBy(*PARTITION)
        .agg(F.max("commit").alias("position"))
        .where("position is not null")
    )
