"""What a small micro-batch costs beside its records."""

import time

from pyspark.sql import functions as F

from tidelog.sources.log_table import write_log
from tidelog.sources.shared import new_folder
from tidelog.streaming import delivery, order


def a_log(spark, segments=8):
    rows = spark.range(4_000).select(F.lit("t").alias("topic"), F.lit(0).alias("part"), F.col("id").alias("n"))
    return write_log(rows, new_folder(spark, "log"), ["n"], segments=segments)


def tasks_of_a_batch(spark, job):
    """Tasks that a drained query ran for each of its batches."""
    time.sleep(1)  # the tracker learns of tasks a little later
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(str(job.runId)) for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    return sum(i.numCompletedTasks for i in infos if i) / (job.lastProgress.batchId + 1)


def succeed():
    return lambda batch: [None] * len(batch)


def test_dedup_merges_its_intervals_once_a_batch(spark):
    stream, folder = a_log(spark).read_stream(spark, 1), new_folder(spark, "dedup")
    job = order.deduplicate(stream, folder, "dedup_cost", drain=True, fold_every=2)
    job.awaitTermination()
    assert job.lastProgress.batchId == 7 and tasks_of_a_batch(spark, job) <= 16
    assert order.deduplicated(spark, folder, stream.schema).select("roff").distinct().count() == 4_000


def test_a_resumed_run_works_out_its_positions_once(spark):
    stream, old, new = a_log(spark).read_stream(spark, 1), new_folder(spark, "old"), new_folder(spark, "new")
    commit = lambda n, low: spark.createDataFrame(
        [("t", 0, low, low + 1_000, low + 1_000)], delivery.RANGES
    ).write.parquet(f"{old}/commits/batch_id={n}")
    commit(0, 0)
    resumed = delivery.resume(stream, delivery.positions(spark, old))
    commit(1, 1_000)  # the old run was not dead yet
    job = delivery.consume_at_least_once(resumed, succeed(), new, "resumed_cost", drain=True)
    job.awaitTermination()
    assert job.lastProgress.batchId == 7 and tasks_of_a_batch(spark, job) <= 6
    done = delivery.results(spark, new, stream.schema).agg(F.min("roff"), F.count(F.lit(1))).first()
    assert tuple(done) == (1_000, 3_000)


def test_claims_take_few_tasks_and_no_job_before_them(spark):
    log, folder = a_log(spark), new_folder(spark, "claims")
    stream = log.read_stream(spark, 1)
    job = delivery.consume_at_most_once(
        stream, succeed(), folder, "claims_cost", drain=True, ordered=False, claims=log.ranges_of_batch
    )
    job.awaitTermination()
    assert job.lastProgress.batchId == 7 and tasks_of_a_batch(spark, job) <= 4
    assert delivery.positions(spark, folder).first().position == 4_000
