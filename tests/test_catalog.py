from tidelog.operators import catalog

EXISTING = "topic string, parts bigint, err string"
WANTED = "topic string, want_parts int"
RESPONSES = "operation string, topic string, err string"


def test_list_topics(spark):
    listed = spark.createDataFrame(
        [
            ("name_space-topic3", 1, None),
            ("name_space-mytopic", 1, None),
            ("name_space-topic2", 1, "UNKNOWN_TOPIC_OR_PARTITION"),
            ("topic4", 1, None),
            ("name_space-topic1", 1, None),
        ],
        EXISTING,
    )
    got = [tuple(r) for r in catalog.list_topics(listed, "name_space").collect()]
    assert [t for t, err in got if err is None] == ["name_space-mytopic", "name_space-topic1", "name_space-topic3"]
    assert [t for t, err in got if err] == ["name_space-topic2"]


def test_create_plan(spark, rows):
    existing = spark.createDataFrame([("name_space-topic0", 1, None)], EXISTING)
    wanted = spark.createDataFrame([(f"name_space-topic{n}", 123) for n in (0, 1, 2, 3, 4, 4)], WANTED)
    plan = catalog.topic_plan(wanted, existing)
    assert rows(plan.where("missing"), "topic") == [(f"name_space-topic{n}",) for n in (1, 2, 3, 4)]
    assert rows(plan.where("grow"), "topic", "want_parts") == [("name_space-topic0", 123)]
    assert rows(catalog.missing_topics(wanted, existing)) == [(f"name_space-topic{n}",) for n in (1, 2, 3, 4)]
    configs = {"retention.ms": "123", "cleanup.policy": "compact,delete"}
    assert rows(catalog.alterable_configs(plan, configs)) == [("name_space-topic0", "retention.ms", "123")]
    assert catalog.alterable_configs(plan, {"cleanup.policy": "compact"}).count() == 0


def test_broker_default_never_grows_and_unknown_topics_are_missing(spark, rows):
    existing = spark.createDataFrame([("a", 1, None), ("b", 0, "UNKNOWN_TOPIC_OR_PARTITION")], EXISTING)
    wanted = spark.createDataFrame([("a", -1), ("b", -1)], WANTED)
    plan = catalog.topic_plan(wanted, existing)
    assert rows(plan, "topic", "missing", "existing", "grow") == [("a", False, True, False), ("b", True, False, False)]


def test_created_and_deleted(spark, rows):
    created = spark.createDataFrame(
        [
            ("create", "ns-topic1", "TOPIC_ALREADY_EXISTS"),
            ("create", "ns-topic2", "INVALID_TOPIC_EXCEPTION"),
            ("create", "ns-topic3", None),
            ("create", "ns-topic4", "TOPIC_ALREADY_EXISTS"),
        ],
        RESPONSES,
    )
    assert rows(catalog.topics_created(created, "ns")) == [("topic2", "failure", 1), ("topic3", "success", 1)]
    deleted = spark.createDataFrame(
        [
            ("delete", "ns-topic1", "UNKNOWN_TOPIC_OR_PARTITION"),
            ("delete", "ns-topic2", "INVALID_TOPIC_EXCEPTION"),
            ("delete", "ns-topic3", None),
        ],
        RESPONSES,
    )
    dim = spark.createDataFrame([("topic3", "web")], "topic string, team string")
    assert rows(catalog.topics_deleted(deleted, "ns", dim)) == [
        ("topic2", "failure", 1, None),
        ("topic3", "success", 1, "web"),
    ]


def test_errors_are_joined_by_line(spark):
    responses = spark.createDataFrame(
        [
            ("delete", "ns-b", "BROKEN"),
            ("delete", "ns-a", "BROKEN"),
            ("delete", "ns-a", "BROKEN"),
            ("delete", "ns-c", "UNKNOWN_TOPIC_OR_PARTITION"),
            ("create", "ns-d", None),
        ],
        RESPONSES,
    )
    got = catalog.joined_errors(responses, "ns").collect()
    assert [(r.operation, r.errors, r.lines) for r in got] == [
        ("delete", 'failed to delete topic "a": BROKEN\nfailed to delete topic "b": BROKEN', 2)
    ]
