from pyspark.sql import functions as F

from tidelog.operators import metrics

BATCH = "topic string, part int, codec_id int, num_records bigint, compressed_bytes bigint, uncompressed_bytes bigint"
POINT = "metric string, unit string, attrs map<string,string>, value bigint"


def batches(spark):
    return spark.createDataFrame(
        [("ns-a", 0, 0, 3, 24, 24), ("ns-a", 0, 2, 3, 53, 114), ("ns-a", 0, 2, 1, 10, 20), ("ns-b", 1, 9, 2, 5, 6), ("ns-b", 1, 8, 2, 5, 6)],
        BATCH,
    )


def test_batch_counters(spark, rows):
    sums = metrics.produce_batch_sums(batches(spark), "ns")
    count = metrics.counter(sums, "producer.messages.count")
    assert rows(count, "topic", "name", "part", "outcome", "codec", "namespace", "value") == [
        ("ns-a", "a", 0, "success", "none", "ns", 3),
        ("ns-a", "a", 0, "success", "snappy", "ns", 4),
        ("ns-b", "b", 1, "success", "unknown", "ns", 4),
    ]
    wire = metrics.counter(sums, "producer.messages.wire.bytes")
    assert rows(wire, "codec", "unit", "value") == [("none", "By", 24), ("snappy", "By", 63), ("unknown", "By", 10)]
    fetched = metrics.fetch_batch_sums(batches(spark), "")
    assert "outcome" not in fetched.columns and "namespace" not in fetched.columns
    raw = metrics.counter(fetched, "consumer.messages.uncompressed.bytes")
    assert rows(raw, "name", "codec", "value")[1] == ("ns-a", "snappy", 134)


def test_compatibility_counters_equal_the_others(spark, rows):
    sums = metrics.produce_batch_sums(batches(spark), "ns")
    values = lambda m: rows(metrics.counter(sums, m), "topic", "codec", "value")
    assert values("messaging.kafka.produce_bytes.count") == values("producer.messages.uncompressed.bytes")
    assert values("messaging.kafka.produce_records.count") == values("producer.messages.count")


def test_topic_attributes_keep_topics_without_any(spark, rows):
    dim = spark.createDataFrame([("a", "web")], "topic string, team string")
    sums = metrics.produce_batch_sums(batches(spark), "ns", dim)
    assert {(r.topic, r.team) for r in sums.collect()} == {("ns-a", "web"), ("ns-b", None)}


def failures(spark):
    return spark.createDataFrame(
        [
            ("ns-t", 0, "deadline_exceeded", False, {"header": "x", "traceparent": "1"}),
            ("ns-t", 0, "deadline_exceeded", False, {"header": "x", "traceparent": "2"}),
            ("ns-t", 0, "canceled", False, {"outcome": "mine"}),
            ("ns-t", 0, "unknown broker error", True, None),
            ("ns-t", 0, "boom", False, None),
            ("ns-t", 0, None, False, None),
        ],
        "topic string, part int, err string, is_broker_err boolean, meta map<string,string>",
    )


def test_failures_by_reason(spark, rows):
    failed = metrics.producer_messages_failed(failures(spark), "ns")
    assert rows(failed, "error_reason", "outcome", "value") == [
        ("canceled", "failure", 1),
        ("timeout", "failure", 2),
        ("unknown broker error", "failure", 1),
        ("unknown", "failure", 1),
    ]


def test_failure_headers_become_dimensions(spark):
    failed = metrics.producer_messages_failed(failures(spark), "ns", metadata="meta")
    points = metrics.to_points(failed, metadata="meta").collect()
    by_reason = {p.attrs["error_reason"]: p for p in points}
    assert by_reason["timeout"].value == 2 and by_reason["timeout"].attrs["header"] == "x"
    assert by_reason["canceled"].attrs["outcome"] == "mine"
    assert by_reason["unknown"].attrs == {
        "messaging.system": "kafka",
        "topic": "ns-t",
        "messaging.destination.name": "t",
        "messaging.kafka.destination.partition": "0",
        "outcome": "failure",
        "error_reason": "unknown",
        "namespace": "ns",
    }


def test_both_outcomes(spark):
    success = metrics.counter(metrics.produce_batch_sums(batches(spark), "ns"), "producer.messages.count")
    both = metrics.producer_messages_all(success, metrics.producer_messages_failed(failures(spark), "ns"))
    assert {r.outcome: r.n for r in both.groupBy("outcome").agg(F.sum("value").alias("n")).collect()} == {"success": 11, "failure": 5}
    assert both.where("outcome = 'failure' and codec is not null").count() == 0


def test_dimension_totals_and_metric_totals(spark, rows):
    points = spark.createDataFrame(
        [("m", "1", {"a": "x", "b": "y"}, 2), ("m", "1", {"a": "x"}, 3), ("m", "1", {}, 5), ("n", "By", {"a": "x"}, 7)],
        POINT,
    )
    assert rows(metrics.dimension_totals(points)) == [
        ("m", "1", "", "", 5),
        ("m", "1", "a", "x", 5),
        ("m", "1", "b", "y", 2),
        ("n", "By", "a", "x", 7),
    ]
    assert metrics.metric_total(points, "m").first().total == 10
    assert metrics.metric_total(points, "absent").first().total == 0
    assert rows(metrics.pick_metrics(points, ["n", "absent"])) == [("absent", 0), ("n", 7)]


def test_batch_points_carry_all_counters(spark):
    sums = metrics.fetch_batch_sums(batches(spark), "ns")
    points = metrics.batch_points(sums, metrics.FETCH_COUNTERS, metrics.FETCH_NAMES)
    assert {r.metric for r in points.collect()} == set(metrics.FETCH_COUNTERS)
    one = points.where("metric = 'consumer.messages.fetched' and attrs['compression.codec'] = 'none'").first()
    assert one.value == 3 and one.attrs["messaging.kafka.source.partition"] == "0"


EVENT = "kind string, operation string, nbytes bigint, wait_us bigint, io_us bigint, err string"


def events(spark):
    return spark.createDataFrame(
        [
            ("write", "Produce", 100, 1_000_000, 500_000, None),
            ("write", "Produce", 70, 6_000_000, 0, "boom"),
            ("read", "Fetch", 30, 2, 3, None),
            ("connect", "", 0, 0, 0, None),
            ("connect", "", 0, 0, 0, "canceled"),
            ("connect", "", 0, 0, 0, "boom"),
            ("disconnect", "", 0, 0, 0, None),
            ("throttle", "", 0, 9, 0, None),
        ],
        EVENT,
    )


def test_broker_counters(spark, rows):
    e = events(spark)
    assert rows(metrics.broker_write_counters(e)) == [("Produce", 100, 1)]
    assert rows(metrics.broker_read_counters(e)) == [(30, 0)]
    assert rows(metrics.broker_connects(e)) == [("failure", "canceled", 1), ("failure", "unknown", 1), ("success", None, 1)]
    assert rows(metrics.broker_connect_errors(e)) == [("canceled", 1), ("unknown", 1)]
    assert rows(metrics.broker_disconnects(e)) == [(1,)]


def test_broker_points(spark, rows):
    got = {(p.metric, tuple(sorted(p.attrs.items()))): (p.unit, p.value) for p in metrics.broker_points(broker_events(spark)).collect()}
    kafka = ("messaging.system", "kafka")
    assert got == {
        (metrics.CONNECTS, (kafka, ("outcome", "success"))): ("1", 2),
        (metrics.CONNECTS, (("error_reason", "timeout"), kafka, ("outcome", "failure"))): ("1", 1),
        (metrics.CONNECT_ERRORS, (("error_reason", "timeout"), kafka)): ("1", 1),
        (metrics.DISCONNECTS, (kafka,)): ("1", 2),
        (metrics.WRITE_ERRORS, (kafka, ("operation", "Produce"))): ("1", 1),
        (metrics.WRITE_BYTES, (kafka, ("operation", "Produce"))): ("By", 12),
        (metrics.WRITE_BYTES, (kafka, ("operation", "Fetch"))): ("By", 0),
        (metrics.READ_BYTES, (kafka,)): ("By", 9),
    }
    named = metrics.dimension_totals(metrics.broker_points(broker_events(spark), "ns"))
    assert (metrics.DISCONNECTS, "1", "namespace", "ns", 2) in rows(named)
    assert metrics.metric_total(metrics.broker_points(broker_events(spark)), metrics.CONNECTS).first().total == 3
    assert metrics.broker_points(broker_events(spark).where("false")).count() == 0


def broker_events(spark):
    return spark.createDataFrame(
        [
            ("connect", None, None, None), ("connect", None, None, None), ("connect", None, None, "deadline_exceeded"),
            ("disconnect", None, None, None), ("disconnect", "Fetch", 4, "boom"), ("throttle", None, None, None),
            ("write", "Produce", 5, None), ("write", "Produce", 7, None), ("write", "Produce", 100, "boom"),
            ("write", "Fetch", None, None), ("read", "Fetch", 9, None), ("read", "Produce", None, None),
        ],
        "kind string, operation string, nbytes bigint, err string",
    )


def test_latency_histograms(spark, rows):
    e = events(spark)
    written = {r.outcome: r for r in metrics.write_latency_histogram(e).collect()}
    assert written["success"].max_us == 1_500_000 and written["failure"].bucket_counts[2] == 1
    assert "operation" not in metrics.read_latency_histogram(e).columns
    assert metrics.throttle_histogram(e).first().min_us == 9


def test_delay_is_measured_from_the_newest_record_of_the_poll(spark, rows):
    polls = spark.createDataFrame(
        [("t", 0, 0, 10, 100), ("t", 0, 0, 11, 90), ("t", 0, 1, 12, 500)],
        "topic string, part int, poll_id bigint, roff bigint, ts_us bigint",
    )
    assert rows(metrics.message_delay(polls), "roff", "delay_us") == [(10, 0), (11, 10), (12, 0)]


def test_fetch_errors_without_a_topic(spark, rows):
    fetched = spark.createDataFrame([("ns-t", 1, "E"), (None, 0, "E"), ("ns-t", 1, None)], "topic string, part int, err string")
    assert rows(metrics.fetch_errors(fetched, "ns")) == [("", 0, "E", 1), ("t", 1, "E", 1)]


def test_failures_that_differ_in_their_trace_are_one_point(spark):
    data = [("ns-t", 0, "boom", False, {"a": "1", "traceparent": f"trace{k}"}) for k in range(2)]
    df = spark.createDataFrame(data, "topic string, part int, err string, is_broker_err boolean, meta map<string,string>")
    points = metrics.to_points(metrics.producer_messages_failed(df, "ns", metadata="meta"), metadata="meta").collect()
    assert [p.value for p in points] == [2] and "traceparent" not in points[0].attrs
