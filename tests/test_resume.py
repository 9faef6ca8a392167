"""Resumed reads by the manifest, claims by the checkpoint, whole polls, placement by key."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.functions.routing import murmur2, partition_by_murmur2
from tidelog.operators import processing
from tidelog.sources import scan
from tidelog.sources.log_table import write_log
from tidelog.sources.shared import new_folder
from tidelog.streaming import delivery


@pytest.fixture(scope="module")
def log(spark):
    """Two topics of two partitions, most records in one of them, in many segments."""
    part = F.when(F.col("id") % 10 == 0, 1).otherwise(0)
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 7 == 0, "small/+ %é").otherwise("t").alias("topic"), part.alias("part"), F.col("id").alias("n"),
        F.repeat(F.lit("v"), 20).alias("rvalue"),
    )
    return write_log(rows, new_folder(spark, "log"), ["n"], segments=24)


def resumed(spark, log, committed):
    marks = spark.createDataFrame(committed, "grp string, topic string, part int, committed bigint")
    return scan.from_commit(log.read_segments(spark), marks, manifest=log.manifest(spark))


def test_manifest_covers_the_log(spark, log, rows):
    found = log.read_segments(spark).groupBy("topic", "part", "segment").agg(F.min("roff"), F.max("roff") + 1, F.count("*"))
    got = rows(found)
    assert [r[:5] for r in got] == rows(log.manifest(spark)) and all(r[4] - r[3] == r[5] for r in got)
    assert len(got) >= 24


def test_only_segments_above_the_commits_are_opened(spark, log, rows):
    ends = {(r.topic, r.part): r.end_off for r in log.ends(spark).collect()}
    committed = [("g", t, p, end - 5) for (t, p), end in ends.items() if (t, p) != ("t", 1)]
    committed += [("h", "small/+ %é", 0, 3)]
    found = resumed(spark, log, committed)
    got = rows(found.groupBy("grp", "topic", "part").agg(F.count("*"), F.min("roff")))
    want = [("g", t, p, 5, end - 5) for (t, p), end in ends.items() if (t, p) != ("t", 1)]
    want += [("g", "t", 1, ends["t", 1], 0), ("h", "small/+ %é", 0, ends["small/+ %é", 0] - 3, 3), ("h", "small/+ %é", 1, ends["small/+ %é", 1], 0)]
    assert got == sorted(want, key=repr)
    # one partition without a commit, the others nearly read
    few = resumed(spark, log, [x for x in committed if x[0] == "g"])
    few.collect()
    scans = scans_of(few._jdf.queryExecution().executedPlan())
    assert len(scans) > 1  # the manifest is read too, and is one file
    read, total = max(metrics(x)["numFiles"] for x in scans), len(log.read(spark).inputFiles())
    assert 1 < read < 0.4 * total


def scans_of(plan):
    """The file scans of a plan that ran, also below exchanges and stages."""
    found, seen = [], set()

    def walk(node):
        if node.id() in seen:
            return
        seen.add(node.id())
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            found.append(node)
        for of, below in (("AdaptiveSparkPlanExec", "executedPlan"), ("QueryStageExec", "plan"), ("ReusedExchangeExec", "child")):
            if name.endswith(of):
                walk(getattr(node, below)())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return found


def metrics(plan):
    found = plan.metrics()
    keys = found.keys().iterator()
    out = {}
    while keys.hasNext():
        key = keys.next()
        out[key] = found.apply(key).value()
    return out


def test_a_group_reads_its_own_topics(spark, log):
    assert {r.topic for r in resumed(spark, log, [("g", "t", 0, 5)]).select("topic").distinct().collect()} == {"t"}
    marks = spark.createDataFrame([("g", "t", 0, 5)], "grp string, topic string, part int, committed bigint")
    assert {r.topic for r in scan.from_commit(log.read(spark), marks).select("topic").distinct().collect()} == {"t"}


def test_claims_read_no_record_and_a_claimed_batch_is_lost(spark, log, rows):
    stream, folder = log.read_stream(spark, 30_000), new_folder(spark, "claims")

    def crash(batch):
        if 900 in set(batch["roff"]):
            raise RuntimeError("lost power")
        return [None] * len(batch)

    start = lambda f: delivery.consume_at_most_once(stream, f, folder, "c", drain=True, claims=log.ranges_of_batch)
    with pytest.raises(StreamingQueryException):
        start(crash).awaitTermination()
    start(lambda batch: [None] * len(batch)).awaitTermination()
    done = delivery.results(spark, folder, stream.schema)
    assert 0 < done.count() < 20_000 and done.select("topic", "part", "roff").distinct().count() == done.count()
    got = rows(delivery.positions(spark, folder), "topic", "part", "position")
    assert got == rows(log.ends(spark), "topic", "part", "end_off")


@pytest.mark.parametrize("ordered", [False, True])
def test_whole_polls(spark, rows, ordered, monkeypatch):
    """Polls longer than an Arrow batch come whole; one that fails is the only one."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        log = spark.range(200).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("part"), F.expr("id div 2").alias("roff"))

        def process(poll):
            offsets = poll["roff"].tolist()
            if offsets != list(range(offsets[0], offsets[0] + len(offsets))):
                raise RuntimeError("out of order")
            if offsets[0] == 30:
                raise ValueError("no 30")
            return sum(offsets)

        done = processing.process_polls(scan.with_polls(log, 15).repartition(5), process, "bigint", ordered)
        got = rows(done, "part", "poll_id", "num_records", "result", "error")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    polls = [range(k, min(k + 15, 100)) for k in range(0, 100, 15)]
    want = [(p, n, len(x), None if x[0] == 30 else sum(x), "no 30" if x[0] == 30 else None) for p in (0, 1) for n, x in enumerate(polls)]
    assert got == sorted(want, key=repr)


def plain_murmur2(data: bytes) -> int:
    h = 0x9747B28C ^ len(data)
    for k in range(0, len(data) // 4 * 4, 4):
        w = int.from_bytes(data[k : k + 4], "little") * 0x5BD1E995 & 0xFFFFFFFF
        h = (h * 0x5BD1E995 & 0xFFFFFFFF) ^ ((w ^ w >> 24) * 0x5BD1E995 & 0xFFFFFFFF)
    if len(data) % 4:
        h = (h ^ int.from_bytes(data[len(data) // 4 * 4 :], "little")) * 0x5BD1E995 & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0x5BD1E995 & 0xFFFFFFFF
    return h ^ h >> 15


def test_murmur2(spark):
    # Published test vectors of the hash, as signed numbers.
    known = {
        b"21": -973932308,
        b"foobar": -790332482,
        b"a-little-bit-long-string": -985981536,
        b"a-little-bit-longer-string": -1486304829,
        b"lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
        b"abc": 479470107,
    }
    r = random.Random(4)
    keys = [*known, b"", *[bytes(r.randrange(256) for _ in range(n)) for n in range(1, 40)]]
    df = spark.createDataFrame([(bytearray(k),) for k in keys] + [(None,)], "key binary")
    got = df.select("key", murmur2(F.col("key")).alias("h"), partition_by_murmur2(F.col("key"), 7).alias("p")).collect()
    assert len(got) == len(keys) + 1
    for row in got:
        if row.key is None:
            assert row.h is None and row.p is None
            continue
        data = bytes(row.key)
        assert row.h == plain_murmur2(data) and row.p == (row.h & 0x7FFFFFFF) % 7
        assert data not in known or row.h == known[data] % (1 << 32)
