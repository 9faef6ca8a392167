import pytest

from tidelog.operators import lag

MONITOR = [
    ("topic1", "", "consumer1"),
    ("topic1", "", "consumer2"),
    ("topic2", "", "consumer2"),
    ("topic3", "", "consumer3"),
    ("", "", "connect"),
    ("", "my.*", "consumer3"),
]
MEMBERS = [
    ("consumer1", "topic1", 1),
    ("consumer2", "topic1", 2),
    ("consumer2", "topic2", 3),
    ("consumer2", "topic2", 4),
    ("consumer3", "topic3", 4),
    ("consumer3", "mytopic", 1),
    ("consumer4", "mytopic", 1),
]
COMMITTED = [
    ("consumer1", "topic1", 1, 1),
    ("consumer2", "topic1", 2, 1),
    ("consumer2", "topic2", 3, 1),
    ("consumer3", "mytopic", 1, 1),
    ("consumer4", "mytopic", 1, 1),
]
OFFSETS = [("topic1", 1, 1), ("topic1", 2, 2), ("topic2", 3, 3), ("topic3", 4, 4), ("mytopic", 1, 2)]


def frames(spark, committed=COMMITTED, members=MEMBERS, offsets=None, monitor=MONITOR):
    wire = lambda t: f"name_space-{t}"
    offsets = offsets or [(t, p, n, n, None, None) for t, p, n in OFFSETS]
    return (
        spark.createDataFrame([(g, wire(t), p, o) for g, t, p, o in committed], "grp string, topic string, part int, committed bigint"),
        spark.createDataFrame([(g, wire(t), p, "client_id") for g, t, p in members], "grp string, topic string, part int, client_id string"),
        spark.createDataFrame([(wire(t), *rest) for t, *rest in offsets], "topic string, part int, start_off bigint, end_off bigint, start_err string, end_err string"),
        spark.createDataFrame(monitor, "topic string, regex string, consumer string"),
    )


@pytest.fixture
def state(spark):
    return lag.lag_state(*frames(spark), "name_space")


def test_lag(state, rows):
    assert rows(lag.consumer_group_lag(state), "grp", "topic", "part", "lag") == sorted(
        [
            ("consumer1", "topic1", 1, 0),
            ("consumer1", "topic1", 2, 0),
            ("consumer2", "topic1", 1, 0),
            ("consumer2", "topic1", 2, 1),
            ("consumer2", "topic2", 3, 2),
            ("consumer3", "topic3", 4, 0),
            ("consumer3", "mytopic", 1, 1),
        ],
        key=repr,
    )


def test_assignment(state, rows):
    assert rows(lag.consumer_group_assignment(state), "grp", "topic", "client_id", "partitions") == sorted(
        [
            ("consumer1", "topic1", "client_id", 1),
            ("consumer1", "topic1", "nil", 1),
            ("consumer2", "topic1", "client_id", 1),
            ("consumer2", "topic1", "nil", 1),
            ("consumer2", "topic2", "client_id", 1),
            ("consumer3", "topic3", "client_id", 1),
            ("consumer3", "mytopic", "client_id", 1),
        ],
        key=repr,
    )


def test_partition_without_offsets_is_a_warning(state, rows):
    assert rows(lag.lag_errors(state)) == [("consumer2", "topic2", 4, lag.MISSING_OFFSET, "warn")]


def test_unknown_partition_is_debug_and_start_error_drops_the_row(spark, rows):
    offsets = [
        ("topic1", 1, 0, 5, None, "UNKNOWN_TOPIC_OR_PARTITION"),
        ("topic1", 2, None, 10000, "NOT_LEADER", None),
    ]
    got = lag.lag_state(*frames(spark, committed=[], members=[("consumer1", "topic1", 1)], offsets=offsets), "name_space")
    assert lag.consumer_group_lag(got).count() == 0
    assert rows(lag.lag_errors(got), "part", "err", "severity") == [
        (1, "UNKNOWN_TOPIC_OR_PARTITION", "debug"),
        (2, "NOT_LEADER", "warn"),
    ]


def test_failed_group_and_foreign_topics_are_left_out(spark, rows):
    failed = spark.createDataFrame([("consumer2",)], "grp string")
    inputs = frames(spark)
    got = lag.lag_state(*inputs, "name_space", failed)
    assert "consumer2" not in {r.grp for r in got.collect()}
    assert lag.lag_state(*inputs, "another").count() == 0


def test_commit_past_the_end_is_no_lag(spark):
    got = lag.lag_state(*frames(spark, committed=[("consumer1", "topic1", 1, 9)], members=[]), "name_space")
    assert {r.part: r.lag for r in lag.consumer_group_lag(got).collect()}[1] == 0


def test_regex_rows_never_match_by_name(spark, rows):
    pairs = spark.createDataFrame([("g", "error"), ("g", "click"), ("h", "click"), ("g", "click")], "grp string, topic string")
    monitor = spark.createDataFrame([("error", "cli", "g"), ("click", "", "g")], "topic string, regex string, consumer string")
    assert rows(lag.monitored_topics(pairs, monitor)) == [("g", "click")]


def test_monitored_groups(spark, rows):
    monitor = frames(spark)[3]
    assert [r[0] for r in rows(lag.monitored_groups(monitor))] == ["connect", "consumer1", "consumer2", "consumer3"]


def test_an_error_of_the_commit_comes_first(spark):
    """The same partition fails to list its end and to give its commit: the commit's error stays."""
    from pyspark.sql import functions as F

    offsets = [("topic1", 1, 1, 1, None, "OFFSET_OUT_OF_RANGE"), ("topic1", 2, 2, 2, None, None)]
    committed, *rest = frames(spark, offsets=offsets)
    broken = committed.withColumn("commit_err", F.when(F.col("grp") == "consumer1", "NOT_COORDINATOR"))
    state = lag.lag_state(broken, *rest, "name_space").where("topic = 'topic1'").collect()
    errors = {(r.grp, r.part): r.err for r in state}
    assert errors["consumer1", 1] == "NOT_COORDINATOR"
    assert errors["consumer2", 1] == "OFFSET_OUT_OF_RANGE" and errors["consumer2", 2] is None
