import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import compaction, delivery, processing
from tidelog.sources import scan

POLL = "topic string, part int, poll_id bigint, roff bigint, ok boolean"


def polls(spark, outcomes, max_poll, topic="t", part=0):
    data = [(topic, part, n // max_poll, n, ok) for n, ok in enumerate(outcomes)]
    return spark.createDataFrame(data, POLL)


# name, delivery, first records, poll size, later records, processed by the second run, failed in the first
CASES = [
    ("a whole first poll is lost", "amod", 10, 10, 2, 2, 10),
    ("many small polls, one lost", "amod", 20, 2, 10, 28, 2),
    ("a lone record is lost", "amod", 1, 1, 11, 11, 1),
    ("a whole first poll comes again", "alod", 10, 10, 2, 12, 10),
    ("many small polls, one comes again", "alod", 20, 2, 10, 30, 2),
    ("a lone record comes again", "alod", 1, 1, 11, 12, 1),
    ("only the failed record is there", "alod", 1, 1, 0, 1, 1),
]


@pytest.mark.parametrize("name, kind, initial, max_poll, last, processed, errored", CASES)
def test_second_consumer_takes_over(spark, name, kind, initial, max_poll, last, processed, errored):
    """The first consumer fails its whole first poll and stops; a second one goes on."""
    first = polls(spark, [False] * min(initial, max_poll), max_poll)
    assert first.where("not ok").count() == errored
    commits = delivery.alod_commits(first) if kind == "alod" else delivery.amod_commits(first)
    log = polls(spark, [True] * (initial + last), max_poll)
    at = delivery.final_positions(commits).select(F.lit("g").alias("grp"), "topic", "part", F.col("position").alias("committed"))
    none = spark.createDataFrame([("g", "t", 0, -1)], "grp string, topic string, part int, committed bigint")
    assert scan.from_commit(log, at if at.count() else none).count() == processed


def test_failed_row_is_not_retried_in_a_run(spark):
    log = polls(spark, [False] + [True] * 199, 500)
    assert delivery.alod_commits(log).first().commit == 200
    for kind in ("alod", "amod"):
        assert delivery.lost_records(log, 1, kind).first().lost == 1


def test_loss_and_commits_against_brute_force(spark, rows):
    rng = random.Random(3)
    outcomes = [rng.random() < 0.6 for _ in range(500)] + [False] * 25
    log = polls(spark, outcomes, 10)
    commits, strict = {}, {}
    for poll in range(0, len(outcomes), 10):
        chunk = outcomes[poll : poll + 10]
        good = [poll + n for n, ok in enumerate(chunk) if ok]
        bad = [poll + n for n, ok in enumerate(chunk) if not ok]
        if good:
            commits[poll // 10] = good[-1] + 1
        stop = bad[0] if bad else poll + len(chunk)
        if stop > poll:
            strict[poll // 10] = stop
    assert {r.poll_id: r.commit for r in delivery.alod_commits(log).collect()} == commits
    assert {r.poll_id: r.commit for r in delivery.alod_commits(log, strict=True).collect()} == strict
    final = max(commits.values())
    lost = sum(1 for n, ok in enumerate(outcomes) if not ok and n < final)
    # the same with and without a broadcast of the positions
    assert delivery.lost_records(log, 1).first().lost == lost
    assert delivery.lost_records(log, 10**9).first().lost == lost
    assert delivery.lost_records(log, 1, "amod").first().lost == outcomes.count(False)


def test_ordering_fixture(spark):
    """1500 records of one key, in sequence."""
    log = spark.range(1500).select(
        F.lit("t").alias("topic"), F.lit(1).alias("part"), F.lit("fixed").alias("rkey"), F.col("id").alias("roff")
    )
    for within in (None, ["topic", "part", "rkey"]):
        assert delivery.ordering_violations(log, F.col("roff"), within, block=100).count() == 0


@pytest.mark.parametrize("block", [1, 7, 64, 10_000])
@pytest.mark.parametrize("by_key", [False, True])
def test_ordering_across_blocks_against_brute_force(spark, rows, block, by_key):
    """Offsets have gaps and one key holds most of the records."""
    rng = random.Random(block)
    data, expected, last = [], [], {}
    for n in range(400):
        roff, key = n * 3 + (n % 2), "hot" if rng.random() < 0.7 else f"k{n % 3}"
        group = ("t", 0, key) if by_key else ("t", 0)
        seq = last.get(group, -1) + 1 if rng.random() < 0.8 else rng.randrange(50)
        if group in last and seq != last[group] + 1:
            expected.append((*group, roff, seq, last[group]))
        last[group] = seq
        data.append(("t", 0, key, roff, seq))
    log = spark.createDataFrame(data, "topic string, part int, rkey string, roff bigint, seq bigint").repartition(3)
    within = ["topic", "part", "rkey"] if by_key else ["topic", "part"]
    assert rows(delivery.ordering_violations(log, F.col("seq"), within, block)) == sorted(expected, key=repr)


def test_dispatch_and_revoked(spark, rows):
    fetched = delivery.fetches(polls(spark, [True] * 3, 2).unionByName(polls(spark, [True] * 2, 2, part=1)))
    owners = spark.createDataFrame([("t", 0, "c")], "topic string, part int, client_id string")
    ends = spark.createDataFrame([("t", 0, 3), ("t", 1, 9)], "topic string, part int, end_off bigint")
    assert rows(delivery.dispatch(fetched, owners), "part", "poll_id", "num_records") == [(0, 0, 2), (0, 1, 1)]
    assert rows(delivery.revoked_data_loss(fetched, owners, ends), "part", "hwm", "num_records") == [(1, 9, 2)]
    assert delivery.revoked_data_loss(fetched, owners, ends, "alod").count() == 0


def test_produced_vs_consumed_keeps_one_sided_partitions(spark, rows):
    a = spark.createDataFrame([("t", 0, 5), ("t", 0, 1), ("t", 1, 2)], "topic string, part int, num_records bigint")
    b = spark.createDataFrame([("t", 0, 6), ("u", 0, 4)], "topic string, part int, num_records bigint")
    assert rows(delivery.produced_vs_consumed(a, b)) == [
        ("t", 0, 6, 6, 0, True),
        ("t", 1, 2, 0, 2, False),
        ("u", 0, 0, 4, -4, True),
    ]


def test_groups_all_see_everything(spark):
    log = polls(spark, [True] * 100, 10)
    counts = scan.group_counts(log, [f"g{n}" for n in range(10)]).collect()
    assert len(counts) == 10 and {r.num_records for r in counts} == {100}


def test_dedup(spark):
    log = polls(spark, [True] * 20, 5)
    assert delivery.redelivery_dedup(log.unionByName(log.where("roff > 7"))).count() == 20


def test_rate(spark):
    log = spark.createDataFrame([("t", 0), ("t", 2_000_000), ("u", 5)], "topic string, ts_us bigint")
    got = {r.topic: r.per_second for r in delivery.consume_rate(log, ["topic"]).collect()}
    assert got == {"t": 1.0, "u": None}


# ---- compaction --------------------------------------------------------------------


def test_compacted_fixture(spark, rows):
    """Twenty updates of three keys."""
    final = {"key1": "value1-abc", "key2": "value2-edf", "key3": "value3-xyz"}
    data = [("t", f"key{n % 3 + 1}", f"old{n}", n) for n in range(17)]
    data += [("t", k, v, 17 + n) for n, (k, v) in enumerate(final.items())]
    log = spark.createDataFrame(data, "topic string, rkey string, rvalue string, roff bigint").repartition(5)
    for _ in range(3):
        got = compaction.latest_per_key(log)
        assert {r.rkey: r.rvalue for r in got.collect()} == final


def test_null_values_delete_only_on_request(spark, rows):
    log = spark.createDataFrame([("t", "a", "1", 0), ("t", "a", None, 1), ("t", "b", "2", 2)], "topic string, rkey string, rvalue string, roff bigint")
    assert rows(compaction.latest_per_key(log), "rkey", "rvalue") == [("a", None), ("b", "2")]
    assert rows(compaction.latest_per_key(log, drop_null_values=True), "rkey", "rvalue") == [("b", "2")]


def test_progress_counts_partitions_not_yet_read(spark, rows):
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 5), ("u", 0, 0)], "topic string, part int, end_off bigint")
    at = spark.createDataFrame([("t", 0, 10)], "topic string, part int, position bigint")
    assert rows(compaction.sync_progress(ends, at)) == [("t", 5, False), ("u", 0, True)]
    state = compaction.sync_state(compaction.sync_progress(ends, at))
    assert rows(state, "topic", "state") == [("t", "not synced: 5 remaining"), ("u", "synced")]
    by = compaction.sync_progress(ends, at.withColumn("grp", F.lit("g")), ["grp"])
    assert rows(by) == [("g", "t", 5, False)]


# ---- user functions ----------------------------------------------------------------


def test_record_function(spark, rows):
    def process(record):
        if record["roff"] % 4 == 0:
            raise RuntimeError(f"bad {record['roff']}")

    done = processing.process_records(polls(spark, [True] * 9, 3), processing.each(process))
    assert rows(processing.dead_letters(done), "roff", "error") == [(0, "bad 0"), (4, "bad 4"), (8, "bad 8")]
    assert processing.succeeded(done).count() == 6


def test_batch_function_error_is_reported_and_all_is_read(spark):
    def process(batches):
        next(batches)
        raise RuntimeError("stop")

    got = processing.process_batches(polls(spark, [True] * 50, 5).coalesce(1), process).collect()
    assert [(r.num_records, r.error) for r in got] == [(50, "stop")]


def test_partition_order(spark):
    log = polls(spark, [True] * 200, 5).unionByName(polls(spark, [True] * 200, 5, part=1)).orderBy(F.rand(1))

    def watch():
        seen = {}

        def process(batch):
            errors = []
            for part, roff in zip(batch["part"], batch["roff"]):
                errors.append(None if roff == seen.get(part, -1) + 1 else "order")
                seen[part] = roff
            return errors

        return process

    assert processing.dead_letters(processing.process_records(log, watch(), ordered=True)).count() == 0


def test_a_partition_without_a_commit_is_read_from_its_start(spark, rows):
    log = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(4)], "topic string, part int, roff bigint")
    committed = spark.createDataFrame([("g", "t", 0, 2), ("h", "t", 0, 4)], "grp string, topic string, part int, committed bigint")
    ends = spark.createDataFrame([("t", 0, 4), ("t", 1, 4)], "topic string, part int, end_off bigint")
    for known in (None, ends):
        got = rows(scan.from_commit(log, committed, known), "grp", "part", "roff")
        assert got == [("g", 0, 2), ("g", 0, 3), *[("g", 1, o) for o in range(4)], *[("h", 1, o) for o in range(4)]]


def test_a_loss_without_a_known_end_is_reported(spark, rows):
    fetched = spark.createDataFrame([("t", 0, 5, 2), ("t", 1, 5, 3)], "topic string, part int, poll_id bigint, num_records bigint")
    none = spark.createDataFrame([], "topic string, part int, client_id string")
    ends = spark.createDataFrame([("t", 0, 9)], "topic string, part int, end_off bigint")
    assert rows(delivery.revoked_data_loss(fetched, none, ends), "part", "hwm", "num_records") == [(0, 9, 2), (1, None, 3)]
