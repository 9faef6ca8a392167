import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidelog.functions.headers import headers_to_map
from tidelog.sources import kafka, scan
from tidelog.sources.envelope import WIRE_SCHEMA, from_wire, to_envelope, to_record
from tidelog.sources.log_table import choose_codec, write_log
from tidelog.sources.shared import new_folder, shared_folder


def test_offsets_match_brute_force_with_a_hot_partition(spark):
    """A third of the rows share one partition, and a third share one time."""
    rng = random.Random(1)
    data = []
    for n in range(6000):
        topic, part = ("hot", 0) if n % 3 == 0 else (f"t{n % 5}", n % 4)
        ts = 77 if rng.random() < 0.34 else rng.randrange(1000)
        data.append((topic, part, ts, n, f"v{n}"))
    rng.shuffle(data)
    df = spark.createDataFrame(data, "topic string, part int, ts_us bigint, event_id bigint, rvalue string")
    table = write_log(df.repartition(7), new_folder(spark, "t"), ["ts_us", "event_id"])
    expected = defaultdict(list)
    for topic, part, ts, n, _ in data:
        expected[topic, part].append((ts, n))
    want = {
        (t, p, n): at for (t, p), listed in expected.items() for at, (_, n) in enumerate(sorted(listed))
    }
    got = {(r.topic, r.part, r.event_id): r.roff for r in table.read(spark).collect()}
    assert got == want
    assert table.partitions == len(expected)
    assert {(r.topic, r.part): r.end_off for r in table.ends(spark).collect()} == {
        k: len(v) for k, v in expected.items()
    }


def test_a_hot_partition_is_cut_into_segments(spark):
    df = spark.range(8000).select(
        F.lit("one").alias("topic"), F.lit(0).alias("part"), F.col("id").alias("event_id")
    )
    path = new_folder(spark, "hot")
    table = write_log(df, path, ["event_id"], segments=4)
    sizes = [r["_n"] for r in spark.read.parquet(f"{path}/segments").collect()]
    assert len(sizes) == 4 and max(sizes) < 4000 and sum(sizes) == 8000
    assert table.read(spark).where("roff <> event_id").count() == 0


def test_topic_filter_prunes_directories(spark):
    df = spark.range(100).select(
        F.concat(F.lit("ns-t"), (F.col("id") % 4).cast("string")).alias("topic"),
        F.lit(0).alias("part"),
        F.col("id").alias("event_id"),
        F.lit("x").alias("rvalue"),
    )
    log = write_log(df, new_folder(spark, "prune"), ["event_id"]).read(spark)
    found = scan.scan_topics(log, ["t1"], "ns").select("roff")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "rvalue" not in plan
    assert found.count() == 25


def test_produce_fixture(spark, rows):
    """Eight rows, two without a key; every row carries the call's headers."""
    data = [(None, "1"), (None, "2"), ("key_2", "3"), ("key_3", "4"), ("key_1", "5"), ("key_3", "6"), ("key_1", "7"), ("key_2", "8")]
    df = spark.createDataFrame([("default-topic", k, v, n) for n, (k, v) in enumerate(data)], "topic string, rkey string, rvalue string, n int")
    metadata = F.create_map(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d"))
    envelope = to_envelope(df, "name_space", 10, metadata, spread=F.col("n"))
    back = write_log(envelope, new_folder(spark, "p"), ["n"], codec=choose_codec("gzip,none")).read(spark)
    assert sorted(r.rvalue for r in back.collect()) == list("12345678")
    assert {r.topic for r in back.collect()} == {"name_space-default-topic"}
    assert all(r.m == {"a": "b", "c": "d"} for r in back.select(headers_to_map(F.col("headers")).alias("m")).collect())
    per_key = back.where("rkey is not null").groupBy("rkey").agg(F.countDistinct("part").alias("n"))
    assert {r.n for r in per_key.collect()} == {1}
    assert rows(to_record(back, "name_space"), "topic")[0] == ("default-topic",)


def test_nothing_to_produce(spark):
    empty = spark.createDataFrame([], "topic string, rkey string, rvalue string, n int")
    table = write_log(to_envelope(empty, "ns", 2), new_folder(spark, "e"), ["n"])
    assert table.read(spark).count() == 0 and table.partitions == 0


def test_codec_preferences():
    assert choose_codec() == "snappy"
    assert choose_codec("zstd,none") == "zstd"
    assert choose_codec(["lz4", "gzip"], supported=("gzip",)) == "gzip"
    with pytest.raises(ValueError, match='unknown codec "huh"\nunknown codec "what"'):
        choose_codec("huh,gzip,what")


def test_scan_needs_a_topic(spark):
    log = spark.createDataFrame([], "topic string")
    with pytest.raises(ValueError):
        scan.scan_topics(log, [])
    with pytest.raises(ValueError):
        scan.scan_topics_regex(log, [])


def test_poll_numbers_are_exact_for_large_offsets(spark):
    df = spark.createDataFrame([(2**60 + 3,)], "roff bigint")
    assert df.select(scan.poll_id(F.col("roff"), 500).alias("p")).first().p == (2**60 + 3) // 500


def test_from_wire(spark):
    df = spark.createDataFrame([], WIRE_SCHEMA)
    assert from_wire(df).columns == ["topic", "part", "roff", "rkey", "rvalue", "ts_us", "headers"]
    assert from_wire(df.drop("headers")).columns[-1] == "ts_us"


def test_kafka_options(spark):
    """The connector is not here, so only its options are checked."""
    options = kafka.source_options("b:9092", ["x", "y"], "ns")
    assert options["subscribe"] == "ns-x,ns-y" and options["startingOffsets"] == "earliest"
    assert int(options["maxOffsetsPerTrigger"]) > 0
    pattern = kafka.source_options("b:9092", ["a|b"], "ns", regex=True)
    assert pattern["subscribePattern"] == ".*(?:ns-a|b).*" and "subscribe" not in pattern
    assert kafka.replay_options("b", "raw")["subscribe"] == "raw"
    assert kafka.sink_options("b", "zstd")["kafka.compression.type"] == "zstd"
    ends = spark.createDataFrame([("t", 0, 9), ("t", 1, 4)], "topic string, part int, end_off bigint")
    at = spark.createDataFrame([("t", 1, 3)], "topic string, part int, position bigint")
    assert kafka.starting_offsets(ends, at) == '{"t": {"0": -2, "1": 3}}'
    rows = spark.createDataFrame([("t", 1, "k", "v", None)], "topic string, part int, rkey string, rvalue string, headers array<struct<key:string,value:binary>>")
    assert "partition" not in kafka.sink_rows(rows).columns
    assert "partition" in kafka.sink_rows(rows, own_partitioner=True).columns


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_micros_do_not_depend_on_the_session_zone(spark):
    """The last time falls into a gap of New York's local time."""
    from tidelog.plans.views import micros

    df = spark.sql(
        "select * from values (timestamp_ntz'2024-01-01 00:00:07.179575'),"
        " (timestamp_ntz'1969-12-31 23:59:59.999999'), (timestamp_ntz'2024-03-10 02:30:00') as t(ts)"
    )
    want = [1704067207179575, -1, 1710037800000000]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.us for r in df.select(micros(spark, "ts").alias("us")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_files_hold_unbroken_ranges_in_order_of_time(spark):
    rows_ = spark.range(20_000).select(
        F.concat(F.lit("t"), F.col("id") % 2).alias("topic"), (F.col("id") % 3).cast("int").alias("part"),
        F.col("id").cast("string").alias("rkey"), F.lit("v").alias("rvalue"), F.hash("id").alias("n"), "id",
    )
    table = write_log(rows_, new_folder(spark, "files"), ["n", "id"], segments=8)
    per_file = (
        spark.read.schema(table.schema).parquet(f"{table.path}/log")
        .select("topic", "part", "roff", "_metadata.file_path", "_metadata.file_modification_time")
        .groupBy("topic", "part", "file_path", "file_modification_time")
        .agg(F.min("roff").alias("low"), F.max("roff").alias("high"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    assert len(per_file) > 8 and all(f.high - f.low + 1 == f.n for f in per_file)
    for key in {(f.topic, f.part) for f in per_file}:
        own = sorted((f for f in per_file if (f.topic, f.part) == key), key=lambda f: f.low)
        assert [f.file_modification_time for f in own] == sorted(f.file_modification_time for f in own)
        assert all(a.high + 1 == b.low for a, b in zip(own, own[1:]))


@pytest.mark.parametrize("codec", ["zstd", "gzip", "none", "lz4"])
def test_the_codec_is_in_the_files(spark, codec):
    import glob

    import pyarrow.parquet as pq

    df = spark.createDataFrame([("t", 0, "k", "v" * 100, n) for n in range(50)], "topic string, part int, rkey string, rvalue string, n int")
    table = write_log(df, new_folder(spark, "codec"), ["n"], codec=codec)
    files = glob.glob(f"{table.path}/log/**/*.parquet", recursive=True)
    found = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert found == {{"none": "UNCOMPRESSED", "lz4": "LZ4"}.get(codec, codec.upper())}


def test_a_small_log_is_not_cut_into_as_many_files_as_shuffle_partitions(spark):
    df = spark.range(5000).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("part"), "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    try:
        table = write_log(df, new_folder(spark, "small"), ["id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = table.manifest(spark).collect()
    assert len(found) <= 4
    assert sorted((r.part, r.roff) for r in table.read(spark).collect()) == [(p, n) for p in (0, 1) for n in range(2500)]
    assert table.read(spark).where("roff <> id div 2").count() == 0


@pytest.mark.parametrize("limit, sorts", [(200_000, 1), (0, 2)])
def test_kept_rows_are_sorted_again_only_if_a_shuffle_comes_between(spark, monkeypatch, limit, sorts):
    import glob

    import pyarrow.parquet as pq
    from tidelog.functions import joins
    from tidelog.sources import log_table

    df = spark.range(4000).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("part"), F.hash("id").alias("n"), "id")
    real, calls = type(df).sortWithinPartitions, []
    monkeypatch.setattr(type(df), "sortWithinPartitions", lambda self, *by: calls.append(by) or real(self, *by))
    monkeypatch.setattr(log_table, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(log_table, "bounded", lambda frame, known: joins.bounded(frame, known, limit))
    table = write_log(df.repartition(5), new_folder(spark, "sorted"), ["n", "id"], segments=6)
    assert len(calls) == sorts
    for name in glob.glob(f"{table.path}/log/**/*.parquet", recursive=True):
        offsets = pq.ParquetFile(name).read(["roff"]).column("roff").to_pylist()
        assert offsets == list(range(offsets[0], offsets[0] + len(offsets)))
    assert table.read(spark).select("part", "roff").distinct().count() == 4000
