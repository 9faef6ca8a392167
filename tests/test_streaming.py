import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.operators import compaction, processing
from tidelog.sources.log_table import write_log
from tidelog.sources.shared import new_folder
from tidelog.streaming import delivery, listeners, stateful

SCHEMA = "topic string, part int, roff bigint, rkey string, rvalue string, ts timestamp"


@pytest.fixture
def source(spark):
    """A folder of log files; ``add(offsets)`` appends one file."""
    path = new_folder(spark, "source")

    class Source:
        def __init__(self):
            self.add([])
            self.path = path

        def add(self, offsets, part=0, value="v"):
            data = [("t", part, o, f"k{o % 3}", f"{value}{o}") for o in offsets]
            df = spark.createDataFrame(data, "topic string, part int, roff bigint, rkey string, rvalue string")
            df.withColumn("ts", F.timestamp_seconds(F.col("roff") + 1_000_000_000)).coalesce(1).write.mode("append").parquet(path)

        def stream(self):
            return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)

    return Source()


# User functions are made inside functions, so that they travel to the workers by value.


def succeed():
    return lambda batch: [None] * len(batch)


def fail_offsets(*bad):
    def process(batch):
        return ["bad" if o in bad else None for o in batch["roff"]]

    return process


def offsets(spark, folder, source, failed):
    done = delivery.results(spark, folder, source.stream().schema)
    return sorted(r.roff for r in done.where(F.col("failed") == failed).collect())


def test_alod_dead_letters_and_commits(spark, source):
    source.add(range(5))
    source.add(range(5, 8))
    folder = new_folder(spark, "job")
    delivery.consume_at_least_once(source.stream(), fail_offsets(1, 7), folder, "a", drain=True).awaitTermination()
    assert offsets(spark, folder, source, False) == [0, 2, 3, 4, 5, 6]
    assert offsets(spark, folder, source, True) == [1, 7]
    assert delivery.positions(spark, folder).first().position == 7


@pytest.mark.parametrize("kind", ["alod", "amod"])
def test_crash_in_a_batch(spark, source, kind, tmp_path):
    """The run dies while processing its second batch and restarts on the same checkpoint."""
    source.add(range(3))
    source.add(range(3, 6))
    source.add(range(6, 9))
    folder = new_folder(spark, kind)
    start = delivery.consume_at_least_once if kind == "alod" else delivery.consume_at_most_once

    def crash(batch):
        if 4 in set(batch["roff"]):
            raise RuntimeError("lost power")
        return [None] * len(batch)

    with pytest.raises(StreamingQueryException):
        start(source.stream(), crash, folder, kind, drain=True).awaitTermination()
    start(source.stream(), succeed(), folder, kind, drain=True).awaitTermination()
    done = offsets(spark, folder, source, False)
    if kind == "alod":
        assert done == list(range(9))
    else:
        assert done == [0, 1, 2, 6, 7, 8], "the claimed batch is lost, never repeated"
    assert delivery.positions(spark, folder).first().position == 9


@pytest.mark.parametrize("kind, seen", [("amod", 0), ("alod", 1)])
def test_second_consumer_of_a_failed_record(spark, source, kind, seen):
    """One record, failed by the first consumer; the second starts from the commits."""
    source.add([0])
    start = delivery.consume_at_least_once if kind == "alod" else delivery.consume_at_most_once
    first, second = new_folder(spark, "c1"), new_folder(spark, "c2")
    start(source.stream(), fail_offsets(0), first, "c1", drain=True).awaitTermination()
    resumed = delivery.resume(source.stream(), delivery.positions(spark, first))
    start(resumed, succeed(), second, "c2", drain=True).awaitTermination()
    assert delivery.results(spark, second, source.stream().schema).count() == seen


def test_resume_reads_uncommitted_partitions_from_the_start(spark, source):
    source.add(range(4), part=0)
    source.add(range(3), part=1)
    at = spark.createDataFrame([("t", 0, 2)], "topic string, part int, position bigint")
    folder = new_folder(spark, "r")
    delivery.consume_at_least_once(delivery.resume(source.stream(), at), succeed(), folder, "r", drain=True).awaitTermination()
    done = delivery.results(spark, folder, source.stream().schema)
    assert sorted((r.part, r.roff) for r in done.collect()) == [(0, 2), (0, 3), (1, 0), (1, 1), (1, 2)]


def test_drain_then_go_on(spark, source):
    source.add(range(4))
    folder = new_folder(spark, "d")
    job = delivery.consume_at_most_once(source.stream(), fail_offsets(0), folder, "d", drain=True)
    job.awaitTermination()
    assert not job.isActive
    source.add(range(4, 6))
    delivery.consume_at_most_once(source.stream(), succeed(), folder, "d", drain=True).awaitTermination()
    done = delivery.results(spark, folder, source.stream().schema)
    assert sorted(r.roff for r in done.collect()) == list(range(6))


def test_groups_keep_their_own_position(spark, source):
    source.add(range(10))
    folder = new_folder(spark, "g")
    jobs = delivery.consume_groups(source.stream(), succeed(), folder, ["x", "y"], drain=True)
    for job in jobs.values():
        job.awaitTermination()
    for group in jobs:
        assert delivery.results(spark, f"{folder}/{group}", source.stream().schema).count() == 10


def test_record_function_in_a_stream(spark, source):
    source.add(range(3))

    def process(record):
        if record["rkey"] == "k1":
            raise ValueError("no k1")

    folder = new_folder(spark, "f")
    delivery.consume_at_least_once(source.stream(), processing.each(process), folder, "f", drain=True).awaitTermination()
    dead = delivery.results(spark, folder, source.stream().schema).where("failed").collect()
    assert [(r.roff, r.error) for r in dead] == [(1, "no k1")]


def test_latest_per_key_across_batches_and_restart(spark, source):
    source.add(range(6))
    folder = new_folder(spark, "l")
    schema = source.stream().schema
    stateful.follow_latest(source.stream(), folder, "l", drain=True).awaitTermination()
    # an older offset that arrives late must not win
    source.add([7], value="new")
    source.add([6], value="mid")
    source.add([1], value="late")
    stateful.follow_latest(source.stream(), folder, "l", drain=True).awaitTermination()
    got = {r.rkey: (r.rvalue, r.roff) for r in stateful.latest_view(spark, folder, schema).collect()}
    assert got == {"k0": ("mid6", 6), "k1": ("new7", 7), "k2": ("v5", 5)}
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" not in (spark.conf.get(provider, None) or ""), "the session keeps its setting"


def test_counters_cumulative_and_delta(spark, source):
    source.add(range(4))
    source.add(range(4, 10), part=1)
    source.add(range(10, 12))
    by, measures = ["part"], {"num_records": F.count(F.lit(1))}
    running, deltas = new_folder(spark, "run"), new_folder(spark, "delta")
    stateful.count_running(source.stream(), by, measures, running, "run", drain=True).awaitTermination()
    totals = stateful.running_totals(spark, running, "part int, num_records bigint", by)
    assert {r.part: r.num_records for r in totals.collect()} == {0: 6, 1: 6}
    stateful.count_deltas(source.stream(), by, measures, deltas, "delta", drain=True).awaitTermination()
    per_batch = spark.read.schema("part int, num_records bigint, batch_id bigint").parquet(f"{deltas}/updates")
    assert sorted(r.num_records for r in per_batch.collect()) == [2, 4, 6]


def test_sync_state_of_a_reader(spark, source):
    ends = spark.createDataFrame([("t", 0, 8), ("t", 1, 2)], "topic string, part int, end_off bigint")
    source.add(range(5))
    folder = new_folder(spark, "s")
    run = lambda: delivery.consume_at_least_once(source.stream(), succeed(), folder, "s", drain=True).awaitTermination()
    run()
    state = lambda: compaction.sync_state(compaction.sync_progress(ends, delivery.positions(spark, folder))).first().state
    assert state() == "not synced: 5 remaining"
    source.add(range(5, 8))
    source.add(range(2), part=1)
    run()
    assert state() == "synced"


def test_dedup_stream(spark, source):
    source.add(range(5))
    source.add(range(3, 8))
    folder = new_folder(spark, "dd")
    once = stateful.dedup_stream(source.stream(), "ts", "1 hour")
    delivery.consume_at_least_once(once, succeed(), folder, "dd", drain=True).awaitTermination()
    assert offsets(spark, folder, source, False) == list(range(8))


def test_batch_listener(spark, source):
    source.add(range(4))
    source.add(range(4, 6))
    reports = []
    listener = listeners.BatchListener(lambda *r: reports.append(r))
    spark.streams.addListener(listener)
    try:
        folder = new_folder(spark, "b")
        stream = listeners.observed(source.stream())
        stateful.count_deltas(stream, ["topic"], {"n": F.count(F.lit(1))}, folder, "b", drain=True).awaitTermination()
        for _ in range(50):
            if sum(r[2] for r in reports) == 6:
                break
            spark.sparkContext._jvm.java.lang.Thread.sleep(100)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r[2] for r in reports) == 6 and sum(r[3] for r in reports) == 12
    assert {r[0] for r in reports} == {"b"}


def test_log_table_stream_is_bounded(spark, source):
    """More files than a batch takes: the drain needs several batches."""
    df = spark.range(40).select(
        F.lit("t").alias("topic"), (F.col("id") % 8).cast("int").alias("part"), F.col("id").alias("n")
    )
    table = write_log(df, new_folder(spark, "log"), ["n"])
    folder = new_folder(spark, "bounded")
    job = stateful.count_deltas(
        table.read_stream(spark, bytes_per_trigger=1), ["part"], {"n": F.count(F.lit(1))}, folder, "x", drain=True
    )
    job.awaitTermination()
    counts = spark.read.schema("part int, n bigint, batch_id bigint").parquet(f"{folder}/updates")
    total, batches = counts.agg(F.sum("n"), F.countDistinct("batch_id")).first()
    assert total == 40 and batches >= 8, "a batch takes one file at least"


def test_resume_skips_nothing_when_files_come_in_reverse(spark):
    """The latest offsets are processed first, then the run dies before the lowest."""
    import os

    path = new_folder(spark, "reverse")
    for nth, low in enumerate((300, 200, 100, 0)):
        df = spark.range(low, low + 100).select(
            F.lit("t").alias("topic"), F.lit(0).alias("part"), F.col("id").alias("roff"), F.lit("k").alias("rkey"),
            F.lit("v").alias("rvalue"), F.current_timestamp().alias("ts"),
        )
        df.coalesce(1).write.parquet(f"{path}/n={low}")
        for name in os.listdir(f"{path}/n={low}"):
            if name.endswith(".parquet"):
                os.utime(f"{path}/n={low}/{name}", (1_000_000 + nth, 1_000_000 + nth))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path).drop("n")

    def crash(batch):
        if batch["roff"].min() == 0:
            raise RuntimeError("lost power")
        return [None] * len(batch)

    first, second = new_folder(spark, "r1"), new_folder(spark, "r2")
    with pytest.raises(StreamingQueryException):
        delivery.consume_at_least_once(stream, crash, first, "r1", drain=True).awaitTermination()
    assert delivery.results(spark, first, stream.schema).count() == 300
    assert delivery.positions(spark, first).count() == 0, "the lowest offset was never handled"
    resumed = delivery.resume(stream, delivery.positions(spark, first))
    delivery.consume_at_least_once(resumed, succeed(), second, "r2", drain=True).awaitTermination()
    done = delivery.results(spark, second, stream.schema)
    assert sorted(r.roff for r in done.collect()) == list(range(400))
    assert delivery.positions(spark, second).first().position == 400


def test_positions_stop_at_a_gap(spark):
    folder = new_folder(spark, "gap")
    ranges = [("t", 0, 0, 10, 10, 0), ("t", 0, 20, 30, 30, 1), ("t", 0, 10, 15, None, 2), ("t", 1, 5, 9, 9, 0)]
    df = spark.createDataFrame(ranges, "topic string, part int, first bigint, next bigint, commit bigint, batch_id bigint")
    df.write.partitionBy("batch_id").parquet(f"{folder}/commits")
    at = lambda start=None: {r.part: r.position for r in delivery.positions(spark, folder, start).collect()}
    assert at() == {0: 10}
    assert at(spark.createDataFrame([("t", 1, 5)], "topic string, part int, position bigint")) == {0: 10, 1: 9}
