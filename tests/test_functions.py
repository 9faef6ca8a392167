from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelog.functions import headers as hdr
from tidelog.functions import labels, naming
from tidelog.functions.histogram import (
    DEFAULT_BOUNDS,
    bucket_index,
    half_octave_bounds,
    histogram,
    histogram_summary,
)
from tidelog.functions.joins import bounded
from tidelog.functions.routing import partition_for_key


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "topic, ns, bare",
    [
        ("ns-topic", "ns", "topic"),
        ("ns-ns-topic", "ns", "ns-topic"),
        ("topic", "ns", "topic"),
        ("my-ns-topic", "ns", "my-ns-topic"),
        ("a.b-topic", "a.b", "topic"),
        ("aXb-topic", "a.b", "aXb-topic"),
        ("topic", "", "topic"),
        ("ns-", "ns", ""),
    ],
)
def test_strip_namespace(spark, topic, ns, bare):
    assert one(spark, naming.strip_namespace(F.lit(topic), ns)) == bare


def test_add_namespace(spark):
    assert one(spark, naming.add_namespace(F.lit("t"), "ns")) == "ns-t"
    assert one(spark, naming.add_namespace(F.lit("t"), "")) == "t"


def test_in_namespace_keeps_all_without_one(spark):
    df = spark.createDataFrame([("ns-a",), ("b",)], "topic string")
    assert naming.in_namespace(df, "").count() == 2
    assert [r.topic for r in naming.in_namespace(df, "ns").collect()] == ["ns-a"]


def test_regex_prefix_covers_first_branch_only(spark):
    match = lambda t: one(spark, naming.topic_regex(["a|b"], "ns", F.lit(t)))
    assert match("ns-a") and match("other-b") and not match("other-a")


def header(key, value):
    return F.struct(F.lit(key).alias("key"), F.lit(value).cast("binary").alias("value"))


def test_last_header_wins(spark):
    listed = F.array(header("a", "1"), header("b", "2"), header("a", "3"), header("a", "4"))
    assert one(spark, hdr.headers_to_map(listed)) == {"a": "4", "b": "2"}
    assert one(spark, hdr.headers_to_map(F.lit(None).cast("array<struct<key:string,value:binary>>"))) == {}


def test_map_to_headers_is_sorted(spark):
    m = F.create_map(F.lit("c"), F.lit("d"), F.lit("a"), F.lit("b"))
    assert [(h.key, bytes(h.value)) for h in one(spark, hdr.map_to_headers(m))] == [
        ("a", b"b"),
        ("c", b"d"),
    ]


def test_enrich_overrides_and_accepts_nothing(spark):
    start = F.create_map(F.lit("a"), F.lit("b"))
    assert one(spark, hdr.enrich(start, F.lit("a"), F.lit("z"))) == {"a": "z"}
    assert one(spark, hdr.enrich(F.lit(None).cast("map<string,string>"), F.lit("k"), F.lit("v"))) == {"k": "v"}


def test_trace_header_is_no_dimension(spark):
    m = F.create_map(F.lit("traceparent"), F.lit("x"), F.lit("Traceparent"), F.lit("y"))
    assert one(spark, hdr.header_dimensions(m)) == {"Traceparent": "y"}


def test_dimension_precedence(spark):
    dims = hdr.record_dimensions(
        F.create_map(F.lit("outcome"), F.lit("fixed"), F.lit("topic"), F.lit("t")),
        F.create_map(F.lit("outcome"), F.lit("header"), F.lit("team"), F.lit("header")),
        F.create_map(F.lit("team"), F.lit("attr")),
        "ns",
    )
    assert one(spark, dims) == {"outcome": "header", "topic": "t", "team": "attr", "namespace": "ns"}


def pair(key, value):
    return F.struct(F.lit(key).alias("key"), F.lit(value).alias("value"))


def test_topic_attribute_forms(spark):
    many = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    assert one(spark, hdr.topic_attributes(None, None)) == {}
    assert one(spark, hdr.topic_attributes(many, None)) == {"a": "1", "b": "2"}
    assert one(spark, hdr.topic_attributes(None, pair("k", "v"))) == {"k": "v"}
    assert one(spark, hdr.topic_attributes(None, pair("", ""))) == {}
    assert one(spark, hdr.topic_attributes(many, pair("b", "9"))) == {"a": "1", "b": "9"}


def test_codec_labels(spark):
    got = [one(spark, labels.codec_label(F.lit(c))) for c in (-1, 0, 1, 2, 3, 4, 5)]
    assert got == ["unknown", "none", "gzip", "snappy", "lz4", "zstd", "unknown"]


@pytest.mark.parametrize(
    "err, broker, reason",
    [
        ("deadline_exceeded", False, "timeout"),
        ("canceled", False, "canceled"),
        ("NOT_LEADER", True, "NOT_LEADER"),
        ("boom", False, "unknown"),
    ],
)
def test_produce_reason(spark, err, broker, reason):
    assert one(spark, labels.produce_error_reason(F.lit(err), F.lit(broker))) == reason


def test_connect_reason_ignores_broker_messages(spark):
    assert one(spark, labels.connect_error_reason(F.lit("NOT_LEADER"))) == "unknown"
    assert one(spark, labels.connect_error_reason(F.lit("deadline_exceeded"))) == "timeout"


def test_alter_ignores_nothing(spark):
    got = lambda op, err: one(spark, labels.admin_outcome(F.lit(op), F.lit(err)))
    assert got("alter", labels.INVALID_REQUEST) == "failure"
    assert got("grow", labels.INVALID_REQUEST) == "ignored"
    assert got("create", labels.TOPIC_EXISTS) == "ignored"
    assert got("delete", labels.UNKNOWN_TOPIC) == "ignored"
    assert got("create", labels.UNKNOWN_TOPIC) == "failure"
    assert got("delete", None) == "success"


def test_routing_is_stable_and_spreads_null_keys(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, (F.col("id") % 10).cast("string")).alias("key"), "id"
    )
    routed = df.withColumn("part", partition_for_key(F.col("key"), F.col("id"), 4))
    per_key = routed.where("key is not null").groupBy("key").agg(F.countDistinct("part").alias("n"))
    assert {r.n for r in per_key.collect()} == {1}
    assert routed.where("key is null").select("part").distinct().count() == 2
    assert routed.agg(F.min("part"), F.max("part")).first()[1] <= 3


def test_half_octave_bounds():
    bounds = half_octave_bounds()
    assert len(bounds) == 51
    assert bounds[0] == 0.00390625 and bounds[-1] == 131072
    assert (bounds[1], bounds[9], bounds[17], bounds[47]) == tuple(2.0**k for k in (-7.5, -3.5, 0.5, 15.5))


@pytest.mark.parametrize("bounds", [DEFAULT_BOUNDS, half_octave_bounds(), (1,)])
def test_bucket_bounds_are_inclusive(spark, bounds):
    limits = [Decimal(b) * 1_000_000 for b in bounds]
    values = sorted({int(v) + d for v in limits for d in (-1, 0, 1)} | {0, 10**15})
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = {r.v: r.b for r in df.select("v", bucket_index("v", bounds).alias("b")).collect()}
    assert got == {v: sum(1 for limit in limits if limit < v) for v in values}


def test_histogram_and_summary(spark):
    df = spark.createDataFrame(
        [("a", 0), ("a", 5_000_000), ("a", 5_000_001), ("a", 20_000_000_000), ("b", 7), ("b", None)],
        "name string, us bigint",
    )
    got = {r["name"]: r for r in histogram(df, ["name"], "us").collect()}
    a = got["a"]
    assert (a["count"], int(a["sum_us"]), a["min_us"], a["max_us"]) == (4, 20_010_000_001, 0, 20_000_000_000)
    assert a["bucket_counts"] == [1, 1, 1] + [0] * 12 + [1]
    assert got["b"]["count"] == 1
    summary = histogram_summary(histogram(df, ["name"], "us"), ["name"]).where("labels = '(name:a)'").first()
    assert summary["midrange_us"] == 10_000_000_000.0
    assert summary["mean_us"] == 20_010_000_001 / 4


def test_histogram_sum_beyond_a_long(spark):
    df = spark.range(4).select(F.lit(2**62).cast("bigint").alias("us"))
    assert int(histogram(df, [], "us").first()["sum_us"]) == 2**64


def test_broadcast_only_below_the_limit(spark):
    df = spark.range(10)
    big = spark.range(10).withColumnRenamed("id", "k")
    hinted = lambda n: "ResolvedHint" in big.join(bounded(df, n, 100), big.k == df.id)._jdf.queryExecution().analyzed().toString()
    assert hinted(100) and not hinted(101)


def test_last_of_many_equal_headers_wins(spark):
    rows = [([("k%d" % (n * 7 % m), str(n).encode()) for n in range(size)],) for size, m in ((0, 1), (1, 1), (400, 3), (400, 400), (50, 49))]
    rows += [([("a", None), ("b", b"x"), ("a", b"y"), ("b", None)],), (None,)]
    df = spark.createDataFrame(rows, "h array<struct<key:string,value:binary>>")
    got = [r.m for r in df.select(hdr.headers_to_map(F.col("h")).alias("m")).collect()]
    assert got == [{k: v.decode() if v is not None else None for k, v in (h or [])} for h, in rows]
