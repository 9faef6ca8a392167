"""Counters and histograms over batch, record and broker events.

Counters come as flat frames, one column per dimension; ``to_points`` turns any of them
into the long form ``metric, unit, attrs map<string,string>, value``. Raw rows are always
summed on their own columns first; labels and topic attributes are joined to the sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.headers import EMPTY, header_dimensions, record_dimensions
from tidelog.functions.histogram import DEFAULT_BOUNDS, histogram
from tidelog.functions.labels import (
    codec_label,
    connect_error_reason,
    outcome,
    produce_error_reason,
)
from tidelog.functions.naming import strip_namespace

# Metric names, with the summed column and the unit of each.
PRODUCE_COUNTERS = {
    "producer.messages.count": ("num_records", "1"),
    "producer.messages.wire.bytes": ("compressed_bytes", "By"),
    "producer.messages.uncompressed.bytes": ("uncompressed_bytes", "By"),
    "messaging.kafka.produce_bytes.count": ("uncompressed_bytes", "By"),
    "messaging.kafka.produce_records.count": ("num_records", "1"),
}
FETCH_COUNTERS = {
    "consumer.messages.fetched": ("num_records", "1"),
    "consumer.messages.wire.bytes": ("compressed_bytes", "By"),
    "consumer.messages.uncompressed.bytes": ("uncompressed_bytes", "By"),
    "messaging.kafka.fetch_bytes.count": ("uncompressed_bytes", "By"),
    "messaging.kafka.fetch_records.count": ("num_records", "1"),
}
CONNECTS, CONNECT_ERRORS = "messaging.kafka.connects.count", "messaging.kafka.connect_errors.count"
DISCONNECTS = "messaging.kafka.disconnects.count"
WRITE_ERRORS, WRITE_BYTES = "messaging.kafka.write_errors.count", "messaging.kafka.write_bytes"
READ_ERRORS, READ_BYTES = "messaging.kafka.read_errors.count", "messaging.kafka.read_bytes"
DELAY = "consumer.messages.delay"
WRITE_LATENCY = "messaging.kafka.write.latency"
READ_LATENCY = "messaging.kafka.read.latency"
THROTTLE = "messaging.kafka.throttling.duration"

# Attribute names of the flat columns, on the producing and consuming side.
_SHARED_NAMES = {"system": "messaging.system", "codec": "compression.codec"}
PRODUCE_NAMES = {
    **_SHARED_NAMES,
    "name": "messaging.destination.name",
    "part": "messaging.kafka.destination.partition",
}
FETCH_NAMES = {
    **_SHARED_NAMES,
    "name": "messaging.source.name",
    "part": "messaging.kafka.source.partition",
}

SIZES = ["num_records", "compressed_bytes", "uncompressed_bytes"]


def with_topic_attributes(
    df: DataFrame, topic_dim: DataFrame | None, namespace: str = ""
) -> DataFrame:
    """``df`` with the extra dimensions of its topics; a topic without any keeps its row.

    ``topic_dim`` is keyed by bare topic, ``df`` may hold wire or bare names.
    """
    if topic_dim is None:
        return df
    keyed = topic_dim.withColumnRenamed("topic", "_bare")
    return df.join(
        keyed, strip_namespace(F.col("topic"), namespace) == F.col("_bare"), "left"
    ).drop("_bare")


def _describe(
    sums: DataFrame, namespace: str, topic_dim: DataFrame | None, **labels: Column
) -> DataFrame:
    """Add the dimensions every message metric has."""
    named = sums.withColumns(
        {
            "system": F.lit("kafka"),
            "name": strip_namespace(F.col("topic"), namespace),
            **labels,
            **({"namespace": F.lit(namespace)} if namespace else {}),
        }
    )
    return with_topic_attributes(named, topic_dim, namespace)


def _batch_sums(batches: DataFrame) -> DataFrame:
    return batches.groupBy("topic", "part", "codec_id").agg(*[F.sum(c).alias(c) for c in SIZES])


def produce_batch_sums(
    batches: DataFrame, namespace: str = "", topic_dim: DataFrame | None = None
) -> DataFrame:
    """Records and bytes of written batches per produce attribute set, in one aggregation."""
    labels = {"outcome": F.lit("success"), "codec": codec_label(F.col("codec_id"))}
    described = _describe(_batch_sums(batches), namespace, topic_dim, **labels)
    return described.drop("codec_id")


def fetch_batch_sums(
    batches: DataFrame, namespace: str = "", topic_dim: DataFrame | None = None
) -> DataFrame:
    """The same for fetched batches; there is no outcome."""
    described = _describe(
        _batch_sums(batches), namespace, topic_dim, codec=codec_label(F.col("codec_id"))
    )
    return described.drop("codec_id")


def counter(sums: DataFrame, metric: str) -> DataFrame:
    """One counter out of batch sums: its dimensions, ``metric``, ``unit`` and ``value``.

    Codec ids with the same label share a point.
    """
    column, unit = {**PRODUCE_COUNTERS, **FETCH_COUNTERS}[metric]
    dims = [c for c in sums.columns if c not in SIZES]
    return (
        sums.groupBy(*dims)
        .agg(F.sum(column).alias("value"))
        .withColumns({"metric": F.lit(metric), "unit": F.lit(unit)})
    )


def producer_messages_failed(
    failures: DataFrame,
    namespace: str = "",
    topic_dim: DataFrame | None = None,
    metadata: str | None = None,
) -> DataFrame:
    """Failed records by reason, one per record; rows without an error are ignored.

    ``failures`` has ``topic, part, err, is_broker_err``. With ``metadata``, the name of a
    map column, its headers become dimensions when the result goes through ``to_points``;
    the trace header, which differs in each record, is left out before anything is counted.
    """
    extra = [metadata] if metadata else []
    failed = failures.where(F.col("err").isNotNull())
    if metadata:
        failed = failed.withColumn(metadata, header_dimensions(F.col(metadata)))
    counted = (
        failed
        .groupBy("topic", "part", "err", "is_broker_err", *extra)
        .agg(F.count(F.lit(1)).alias("value"))
    )
    labels = {
        "outcome": F.lit("failure"),
        "error_reason": produce_error_reason(F.col("err"), F.col("is_broker_err")),
    }
    described = _describe(counted, namespace, topic_dim, **labels).drop("err", "is_broker_err")
    dims = [c for c in described.columns if c != "value"]
    return (
        described.groupBy(*dims)
        .agg(F.sum("value").alias("value"))
        .withColumns({"metric": F.lit("producer.messages.count"), "unit": F.lit("1")})
    )


def producer_messages_all(success: DataFrame, failed: DataFrame) -> DataFrame:
    """Both outcomes of one metric; a dimension one side lacks is null there."""
    return success.unionByName(failed, allowMissingColumns=True)


def to_points(
    flat: DataFrame, names: dict[str, str] | None = None, metadata: str | None = None
) -> DataFrame:
    """Flat counter rows as ``metric, unit, attrs, value``; null dimensions are left out.

    Headers in ``metadata`` come after the fixed attributes and override equal names, but
    not topic attributes or the namespace, which come last.
    """
    names = names or PRODUCE_NAMES
    fixed = {"system", "topic", "name", "part", "outcome", "codec", "operation"}
    dims = [c for c in flat.columns if c not in ("metric", "unit", "value", metadata)]

    def as_map(columns: Sequence[str]) -> Column:
        if not columns:
            return F.expr(EMPTY)
        pairs = ", ".join(f"'{names.get(c, c)}', cast(`{c}` as string)" for c in columns)
        return F.expr(f"map_filter(map({pairs}), (k, v) -> v is not null)")

    if metadata:
        attrs = record_dimensions(
            as_map([c for c in dims if c in fixed]),
            F.col(metadata),
            as_map([c for c in dims if c not in fixed]),
            "",
        )
    else:
        attrs = as_map(dims)
    return flat.select("metric", "unit", attrs.alias("attrs"), "value")


def wanted_counters(
    counters: dict[str, tuple[str, str]], metrics: Sequence[str] | None
) -> dict[str, tuple[str, str]]:
    """Those of ``counters`` that are among ``metrics``; None stands for all."""
    return counters if metrics is None else {m: c for m, c in counters.items() if m in metrics}


def batch_points(sums: DataFrame, counters: dict[str, tuple[str, str]], names: dict[str, str]) -> DataFrame:
    """The named counters of batch sums as points, without scanning the sums once per counter."""
    rows = ", ".join(f"'{m}', '{unit}', `{c}`" for m, (c, unit) in counters.items())
    measures = F.expr(f"stack({len(counters)}, {rows})").alias("metric", "unit", "value")
    dims = [c for c in sums.columns if c not in SIZES]
    return to_points(sums.select(*dims, measures), names)


def pick_metrics(points: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Total of each named metric; one that nothing reported is 0."""
    wanted = F.explode(F.array(*[F.lit(m) for m in metrics]))
    totals = (
        points.where(F.col("metric").isin(*metrics))
        .groupBy("metric")
        .agg(F.sum("value").alias("total"))
    )
    names = points.sparkSession.range(1).select(wanted.alias("metric"))
    return names.join(totals, "metric", "left").select(
        "metric", F.coalesce("total", F.lit(0)).cast("bigint").alias("total")
    )


def metric_total(points: DataFrame, metric: str) -> DataFrame:
    """One row: the sum over all points of a metric, 0 when there are none."""
    return points.where(F.col("metric") == metric).agg(
        F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("total")
    )


def dimension_totals(points: DataFrame) -> DataFrame:
    """Sum per metric, unit and single dimension; a point counts once in each dimension.

    A point without dimensions goes to the empty key and value.
    """
    nothing = F.create_map(F.lit(""), F.lit(""))
    attrs = F.when(F.size("attrs") == 0, nothing).otherwise(F.col("attrs"))
    return (
        points.select("metric", "unit", "value", F.explode(attrs).alias("dim", "dim_value"))
        .groupBy("metric", "unit", "dim", "dim_value")
        .agg(F.sum("value").alias("total"))
    )


def topic_bytes_written(batches: DataFrame) -> DataFrame:
    """Compressed bytes per full topic name."""
    return batches.groupBy("topic").agg(F.sum("compressed_bytes").alias("bytes_written"))


def message_delay(polls: DataFrame) -> DataFrame:
    """``polls`` with ``delay_us``: how long before its poll a record was written.

    The poll's time is that of its newest record. The window's groups are single polls, and
    its sort follows the order the log is stored in.
    """
    poll = Window.partitionBy("topic", "part", "poll_id")
    return polls.withColumn("delay_us", F.max("ts_us").over(poll) - F.col("ts_us"))


def consumer_delay_histogram(
    polls: DataFrame,
    attrs: Sequence[str] = ("topic", "part"),
    bounds: Sequence[float] = DEFAULT_BOUNDS,
) -> DataFrame:
    return histogram(message_delay(polls), list(attrs), "delay_us", bounds)


def describe_delays(
    delays: DataFrame, namespace: str = "", topic_dim: DataFrame | None = None
) -> DataFrame:
    """A delay histogram by topic and part with the dimensions of message metrics.

    They follow from the topic, so they join after the records are counted.
    """
    return _describe(delays, namespace, topic_dim)


def with_latency(events: DataFrame) -> DataFrame:
    """Broker events with ``latency_us``: waiting plus transfer."""
    return events.withColumn("latency_us", F.col("wait_us") + F.col("io_us"))


def write_latency_histogram(
    events: DataFrame, bounds: Sequence[float] = DEFAULT_BOUNDS
) -> DataFrame:
    """By operation and outcome; failed writes are timed too."""
    writes = with_latency(events.where(F.col("kind") == "write"))
    timed = writes.withColumn("outcome", outcome(F.col("err")))
    return histogram(timed, ["operation", "outcome"], "latency_us", bounds)


def read_latency_histogram(
    events: DataFrame, bounds: Sequence[float] = DEFAULT_BOUNDS
) -> DataFrame:
    """By outcome; reads have no operation dimension."""
    reads = with_latency(events.where(F.col("kind") == "read"))
    return histogram(reads.withColumn("outcome", outcome(F.col("err"))), ["outcome"], "latency_us", bounds)


def throttle_histogram(events: DataFrame, bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    throttled = events.where(F.col("kind") == "throttle")
    return histogram(throttled, [], "wait_us", bounds)


def _traffic(events: DataFrame, kind: str, by: Sequence[str]) -> DataFrame:
    failed = F.col("err").isNotNull()
    return (
        events.where(F.col("kind") == kind)
        .groupBy(*by)
        .agg(
            F.coalesce(F.sum(F.when(~failed, F.col("nbytes"))), F.lit(0)).alias("bytes"),
            F.count(F.when(failed, F.lit(1))).alias("errors"),
        )
    )


def broker_write_counters(events: DataFrame) -> DataFrame:
    """Bytes and errors per operation; a failed write adds an error and no bytes."""
    return _traffic(events, "write", ["operation"])


def broker_read_counters(events: DataFrame) -> DataFrame:
    return _traffic(events, "read", [])


def broker_connects(events: DataFrame) -> DataFrame:
    """Connections by outcome; failures carry their reason, successes a null one."""
    tries = events.where(F.col("kind") == "connect")
    reason = F.when(F.col("err").isNotNull(), connect_error_reason(F.col("err")))
    return (
        tries.groupBy(outcome(F.col("err")).alias("outcome"), reason.alias("error_reason"))
        .agg(F.count(F.lit(1)).alias("value"))
    )


def broker_connect_errors(events: DataFrame) -> DataFrame:
    failed = events.where((F.col("kind") == "connect") & F.col("err").isNotNull())
    return failed.groupBy(connect_error_reason(F.col("err")).alias("error_reason")).agg(
        F.count(F.lit(1)).alias("value")
    )


def broker_disconnects(events: DataFrame) -> DataFrame:
    return events.where(F.col("kind") == "disconnect").agg(F.count(F.lit(1)).alias("value"))


def broker_points(events: DataFrame, namespace: str = "") -> DataFrame:
    """All counters of broker events as points, from one aggregation of the events.

    Only what an event's counters are told apart by is grouped on: the operation of a write, the
    reason of a failed connection. The few sums are then turned into one or two points each.
    """
    kind, failed = F.col("kind"), F.col("failed")
    sums = (
        events.where(kind.isin("connect", "disconnect", "read", "write"))
        .groupBy(
            "kind",
            ((kind != "disconnect") & F.col("err").isNotNull()).alias("failed"),
            F.when(kind == "write", F.col("operation")).alias("operation"),
            F.when((kind == "connect") & F.col("err").isNotNull(), connect_error_reason(F.col("err"))).alias("error_reason"),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("nbytes"), F.lit(0)).alias("bytes"))
    )

    def point(applies: Column, metric: str, unit: str, value: str, ending: Column | None = None) -> Column:
        ending = F.lit(None).cast("string") if ending is None else ending
        fields = {"metric": F.lit(metric), "unit": F.lit(unit), "outcome": ending, "value": F.col(value)}
        return F.when(applies, F.struct(*[c.alias(name) for name, c in fields.items()]))

    ending = F.when(failed, "failure").otherwise("success")
    points = [
        point(kind == "connect", CONNECTS, "1", "n", ending),
        point((kind == "connect") & failed, CONNECT_ERRORS, "1", "n"),
        point(kind == "disconnect", DISCONNECTS, "1", "n"),
        point((kind == "write") & failed, WRITE_ERRORS, "1", "n"),
        point((kind == "write") & ~failed, WRITE_BYTES, "By", "bytes"),
        point((kind == "read") & failed, READ_ERRORS, "1", "n"),
        point((kind == "read") & ~failed, READ_BYTES, "By", "bytes"),
    ]
    flat = sums.select("operation", "error_reason", F.inline(F.array_compact(F.array(*points)))).withColumns(
        {"system": F.lit("kafka"), **({"namespace": F.lit(namespace)} if namespace else {})}
    )
    return to_points(flat)


def fetch_errors(fetched: DataFrame, namespace: str = "") -> DataFrame:
    """Fetch results that carry an error, counted per bare topic and partition."""
    return (
        fetched.where(F.col("err").isNotNull())
        .groupBy(
            strip_namespace(F.coalesce("topic", F.lit("")), namespace).alias("topic"), "part", "err"
        )
        .agg(F.count(F.lit(1)).alias("value"))
    )
