"""Queries for the counters and histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.histogram import (
    DEFAULT_BOUNDS,
    half_octave_bounds,
    histogram_summary,
)
from tidelog.functions.labels import (
    codec_label,
    connect_error_reason,
    produce_error_reason,
)
from tidelog.operators import metrics
from tidelog.plans.registry import query
from tidelog.plans.sql import CODEC, CONNECT_REASON, PRODUCE_REASON, bare, histogram_sql
from tidelog.plans.views import NAMESPACE, Inputs
from tidelog.sources.scan import with_polls

DIMS = ["error_reason", "codec", "outcome", "team", "tier"]


def _filled(df: DataFrame) -> DataFrame:
    """Missing dimensions as empty text, the same in both engines."""
    return df.na.fill("", [c for c in DIMS if c in df.columns])


# ---- counters ----------------------------------------------------------------------


def _produced(i: Inputs) -> DataFrame:
    return metrics.produce_batch_sums(i.batch_log, NAMESPACE, i.topic_dim)


def _fetched(i: Inputs) -> DataFrame:
    return metrics.fetch_batch_sums(i.batch_log, NAMESPACE, i.topic_dim)


def _failed(i: Inputs) -> DataFrame:
    return metrics.producer_messages_failed(i.produce_failure_log, NAMESPACE, i.topic_dim)


def _counter_sql(metric: str) -> str:
    producing = metric in metrics.PRODUCE_COUNTERS
    column, unit = (metrics.PRODUCE_COUNTERS if producing else metrics.FETCH_COUNTERS)[metric]
    outcome = "'success' as outcome, " if producing else ""
    return f"""
select 'kafka' as system, b.topic, {bare('b.topic')} as name, b.part, {outcome}b.codec, 'name_space' as namespace,
       coalesce(d.team, '') as team, coalesce(d.tier, '') as tier, '{metric}' as metric, '{unit}' as unit,
       cast(sum(b.{column}) as bigint) as value
from (select *, {CODEC} as codec from batch_log) b left join topic_dim d on d.topic = {bare('b.topic')}
group by b.topic, b.part, b.codec, d.team, d.tier"""


FAILED_SQL = f"""
select 'kafka' as system, f.topic, {bare('f.topic')} as name, f.part, 'failure' as outcome, f.error_reason,
       'name_space' as namespace, coalesce(d.team, '') as team, coalesce(d.tier, '') as tier,
       'producer.messages.count' as metric, '1' as unit, count(*) as value
from (select *, {PRODUCE_REASON} as error_reason from produce_failure_log) f
left join topic_dim d on d.topic = {bare('f.topic')}
group by f.topic, f.part, f.error_reason, d.team, d.tier"""


def _register_counter(name: str, metric: str) -> None:
    sums = _produced if metric in metrics.PRODUCE_COUNTERS else _fetched

    @query(name, _counter_sql(metric))
    def build(i: Inputs) -> DataFrame:
        return _filled(metrics.counter(sums(i), metric))


for _name, _metric in {
    "producer_messages_count": "producer.messages.count",
    "producer_wire_bytes": "producer.messages.wire.bytes",
    "producer_uncompressed_bytes": "producer.messages.uncompressed.bytes",
    "consumer_messages_fetched": "consumer.messages.fetched",
    "consumer_wire_bytes": "consumer.messages.wire.bytes",
    "consumer_uncompressed_bytes": "consumer.messages.uncompressed.bytes",
}.items():
    _register_counter(_name, _metric)


def _pair_sql(first: str, second: str) -> str:
    return f"{_counter_sql(first)} union all by name {_counter_sql(second)}"


@query(
    "compat_produce_counters",
    _pair_sql("messaging.kafka.produce_bytes.count", "messaging.kafka.produce_records.count"),
)
def compat_produce_counters(i: Inputs) -> DataFrame:
    sums = _produced(i)
    size = metrics.counter(sums, "messaging.kafka.produce_bytes.count")
    return _filled(size.unionByName(metrics.counter(sums, "messaging.kafka.produce_records.count")))


@query(
    "compat_fetch_counters",
    _pair_sql("messaging.kafka.fetch_bytes.count", "messaging.kafka.fetch_records.count"),
)
def compat_fetch_counters(i: Inputs) -> DataFrame:
    sums = _fetched(i)
    size = metrics.counter(sums, "messaging.kafka.fetch_bytes.count")
    return _filled(size.unionByName(metrics.counter(sums, "messaging.kafka.fetch_records.count")))


@query("producer_messages_failed", FAILED_SQL)
def producer_messages_failed(i: Inputs) -> DataFrame:
    return _filled(_failed(i))


@query(
    "producer_failed_by_header",
    f"""select f.topic, f.part, f.error_reason, f.tenant, count(*) as value
        from (select *, {PRODUCE_REASON} as error_reason, cast(k % 3 as varchar) as tenant from produce_failure_log) f
        group by f.topic, f.part, f.error_reason, f.tenant""",
)
def producer_failed_by_header(i: Inputs) -> DataFrame:
    """One point for each tenant: the trace header differs in every record and is no dimension."""
    tenant = (F.col("k") % 3).cast("string")
    trace = F.concat_ws("-", "topic", "part", "roff")
    meta = F.create_map(F.lit("tenant"), tenant, F.lit("traceparent"), trace)
    failed = metrics.producer_messages_failed(i.produce_failure_log.withColumn("meta", meta), NAMESPACE, metadata="meta")
    return failed.select("topic", "part", "error_reason", F.col("meta")["tenant"].alias("tenant"), "value")


ALL_SQL = f"""
select * replace (coalesce(codec, '') as codec, coalesce(error_reason, '') as error_reason)
from ({_counter_sql('producer.messages.count')} union all by name {FAILED_SQL}) u"""


@query("producer_messages_all", ALL_SQL)
def producer_messages_all(i: Inputs) -> DataFrame:
    success = metrics.counter(_produced(i), "producer.messages.count")
    return _filled(metrics.producer_messages_all(success, _failed(i)))


@query(
    "topic_attributes",
    f"""select b.topic, coalesce(d.team, '') as team, coalesce(d.tier, '') as tier, count(*) as num_batches
        from batch_log b left join topic_dim d on d.topic = {bare('b.topic')} group by b.topic, d.team, d.tier""",
)
def topic_attributes(i: Inputs) -> DataFrame:
    counts = i.batch_log.groupBy("topic").agg(F.count(F.lit(1)).alias("num_batches"))
    return _filled(metrics.with_topic_attributes(counts, i.topic_dim, NAMESPACE))


@query(
    "topic_bytes_written",
    "select topic, cast(sum(compressed_bytes) as bigint) as bytes_written from batch_log group by topic",
)
def topic_bytes_written(i: Inputs) -> DataFrame:
    return metrics.topic_bytes_written(i.batch_log)


@query(
    "batch_listener",
    "select topic, part, poll_id, compressed_bytes as bytes_written from batch_log",
)
def batch_listener(i: Inputs) -> DataFrame:
    """What a listener is told, as a table: one row per batch."""
    return i.batch_log.select(
        "topic", "part", "poll_id", F.col("compressed_bytes").alias("bytes_written")
    )


@query(
    "codec_label",
    f"select codec_id, {CODEC} as codec, count(*) as num_batches from batch_log group by codec_id",
)
def codec_label_query(i: Inputs) -> DataFrame:
    counts = i.batch_log.groupBy("codec_id").agg(F.count(F.lit(1)).alias("num_batches"))
    return counts.withColumn("codec", codec_label(F.col("codec_id")))


@query(
    "produce_error_reason",
    f"""select err, {PRODUCE_REASON} as error_reason, count(*) as num
        from produce_failure_log group by err, is_broker_err""",
)
def produce_error_reason_query(i: Inputs) -> DataFrame:
    counts = i.produce_failure_log.groupBy("err", "is_broker_err").agg(
        F.count(F.lit(1)).alias("num")
    )
    reason = produce_error_reason(F.col("err"), F.col("is_broker_err"))
    return counts.withColumn("error_reason", reason).drop("is_broker_err")


@query(
    "connect_error_reason",
    f"""select err, {CONNECT_REASON} as error_reason, count(*) as num
        from broker_event_log where kind = 'connect' and err is not null group by err""",
)
def connect_error_reason_query(i: Inputs) -> DataFrame:
    failed = i.broker_event_log.where((F.col("kind") == "connect") & F.col("err").isNotNull())
    counts = failed.groupBy("err").agg(F.count(F.lit(1)).alias("num"))
    return counts.withColumn("error_reason", connect_error_reason(F.col("err")))


@query(
    "fetch_errors",
    f"""select {bare()} as topic, part, err, count(*) as value from produce_failure_log
        group by 1, 2, 3""",
)
def fetch_errors(i: Inputs) -> DataFrame:
    return metrics.fetch_errors(i.produce_log, NAMESPACE)


# ---- points ------------------------------------------------------------------------


def _points(i: Inputs, wanted: Sequence[str] | None = None) -> DataFrame:
    """The counters of the log as points; only what ``wanted`` needs is computed."""
    parts = []
    for sums, counters, names in (
        (_produced, metrics.PRODUCE_COUNTERS, metrics.PRODUCE_NAMES),
        (_fetched, metrics.FETCH_COUNTERS, metrics.FETCH_NAMES),
    ):
        some = metrics.wanted_counters(counters, wanted)
        if some:
            parts.append(metrics.batch_points(sums(i), some, names))
    if wanted is None or "producer.messages.count" in wanted:
        parts.append(metrics.to_points(_failed(i), metrics.PRODUCE_NAMES))
    return reduce(DataFrame.unionByName, parts)


def _points_sql() -> str:
    """The same points with one column per dimension."""
    parts = [_counter_sql(m) for m in (*metrics.PRODUCE_COUNTERS, *metrics.FETCH_COUNTERS)]
    return " union all by name ".join([*parts, FAILED_SQL])


def _dimension_sql() -> str:
    shared = {"system": "messaging.system", "topic": "topic", "outcome": "outcome", "codec": "compression.codec",
              "team": "team", "tier": "tier", "namespace": "namespace", "error_reason": "error_reason"}
    fetch = ", ".join(f"'{m}'" for m in metrics.FETCH_COUNTERS)
    rows = [
        f"select metric, unit, '{dim}' as dim, {column} as dim_value, value from p where {column} is not null and {column} <> ''"
        for column, dim in shared.items()
    ]
    for column, suffix in (("name", "name"), ("part", "partition")):
        for side, test in (("source", f"metric in ({fetch})"), ("destination", f"metric not in ({fetch})")):
            dim = f"messaging.{'kafka.' if suffix == 'partition' else ''}{side}.{suffix}"
            rows.append(
                f"select metric, unit, '{dim}', cast({column} as varchar), value from p where {test}"
            )
    union = " union all ".join(rows)
    return f"""
select metric, unit, dim, dim_value, cast(sum(value) as bigint) as total
from (with p as ({_points_sql()}) {union}) t group by metric, unit, dim, dim_value"""


@query("dimension_totals", _dimension_sql())
def dimension_totals(i: Inputs) -> DataFrame:
    return metrics.dimension_totals(_points(i))


PICKED = ["producer.messages.count", "consumer.messages.wire.bytes", "producer.messages.produced"]


@query(
    "metric_scope_filter",
    f"""select m.metric, cast(coalesce(sum(p.value), 0) as bigint) as total
        from (select unnest([{', '.join(repr(m) for m in PICKED)}]) as metric) m
        left join ({_points_sql()}) p on p.metric = m.metric group by m.metric""",
)
def metric_scope_filter(i: Inputs) -> DataFrame:
    """The last name is one that nothing reports."""
    return metrics.pick_metrics(_points(i, PICKED), PICKED)


@query(
    "metric_total",
    f"select cast(sum(value) as bigint) as total from ({_points_sql()}) p where metric = 'producer.messages.count'",
)
def metric_total(i: Inputs) -> DataFrame:
    return metrics.metric_total(_points(i, ["producer.messages.count"]), "producer.messages.count")


# ---- histograms --------------------------------------------------------------------


def _by_bucket(hist: DataFrame, attrs: Sequence[str]) -> DataFrame:
    return hist.select(
        *attrs,
        "count",
        F.col("sum_us").cast("bigint").alias("sum_us"),
        "min_us",
        "max_us",
        F.posexplode("bucket_counts").alias("bucket", "bucket_count"),
    )


@query(
    "consumer_delay_histogram",
    f"""select h.*, 'kafka' as system, {bare('h.topic')} as name, 'name_space' as namespace,
               coalesce(d.team, '') as team, coalesce(d.tier, '') as tier
        from ({histogram_sql("select * from message_delay", ["topic", "part"], "delay_us", DEFAULT_BOUNDS)}) h
        left join topic_dim d on d.topic = {bare('h.topic')}""",
)
def consumer_delay_histogram(i: Inputs) -> DataFrame:
    delays = metrics.describe_delays(metrics.consumer_delay_histogram(i.poll_log), NAMESPACE, i.topic_dim)
    return _filled(_by_bucket(delays, ["topic", "part", "system", "name", "namespace", "team", "tier"]))


LATENCY = """select operation, case when err is null then 'success' else 'failure' end as outcome,
                    wait_us + io_us as latency_us from broker_event_log where kind = """


LATENCY_BOUNDS = half_octave_bounds()


@query(
    "write_latency_histogram",
    histogram_sql(LATENCY + "'write'", ["operation", "outcome"], "latency_us", LATENCY_BOUNDS),
)
def write_latency_histogram(i: Inputs) -> DataFrame:
    hist = metrics.write_latency_histogram(i.broker_event_log, LATENCY_BOUNDS)
    return _by_bucket(hist, ["operation", "outcome"])


@query(
    "read_latency_histogram",
    histogram_sql(LATENCY + "'read'", ["outcome"], "latency_us", LATENCY_BOUNDS),
)
def read_latency_histogram(i: Inputs) -> DataFrame:
    return _by_bucket(
        metrics.read_latency_histogram(i.broker_event_log, LATENCY_BOUNDS), ["outcome"]
    )


@query(
    "throttle_histogram",
    histogram_sql(
        "select wait_us from broker_event_log where kind = 'throttle'", [], "wait_us", LATENCY_BOUNDS
    ),
)
def throttle_histogram(i: Inputs) -> DataFrame:
    return _by_bucket(metrics.throttle_histogram(i.broker_event_log, LATENCY_BOUNDS), [])


@query(
    "histogram_summary",
    f"""select '(part:' || part || ')(topic:' || topic || ')' as labels, min_us, max_us,
              (min_us + max_us) / 2.0::double as midrange_us, sum_us::double / count as mean_us, sum_us, count,
              string_agg(bucket_count, ',' order by bucket) filter (where bucket < {len(LATENCY_BOUNDS)}) as buckets
       from ({histogram_sql("select * from message_delay", ["topic", "part"], "delay_us", LATENCY_BOUNDS)}) h
       group by topic, part, min_us, max_us, sum_us, count""",
)
def histogram_summary_query(i: Inputs) -> DataFrame:
    """The overflow bucket is not shown."""
    hist = metrics.consumer_delay_histogram(i.poll_log, bounds=LATENCY_BOUNDS)
    shown = F.slice("bucket_counts", 1, F.size("bounds")).cast("array<string>")
    return (
        histogram_summary(hist, ["topic", "part"])
        .withColumn("buckets", F.array_join(shown, ","))
        .withColumn("sum_us", F.col("sum_us").cast("bigint"))
        .drop("bounds", "bucket_counts")
    )


@query(
    "lines_delay_histogram",
    histogram_sql(
        "select topic, part, max(ts_us) over (partition by topic, part, poll_id) - ts_us as delay_us from line_polls",
        ["topic", "part"],
        "delay_us",
        LATENCY_BOUNDS,
    ),
)
def lines_delay_histogram(i: Inputs) -> DataFrame:
    polls = with_polls(i.line_table.read(i.spark))
    return _by_bucket(
        metrics.consumer_delay_histogram(polls, bounds=LATENCY_BOUNDS), ["topic", "part"]
    )


# ---- broker events -----------------------------------------------------------------


@query(
    "batch_latency",
    "select event_id, wait_us + io_us as latency_us from broker_event_log where kind in ('read', 'write')",
)
def batch_latency(i: Inputs) -> DataFrame:
    moved = i.broker_event_log.where(F.col("kind").isin("read", "write"))
    return metrics.with_latency(moved).select("event_id", "latency_us")


TRAFFIC = """cast(coalesce(sum(nbytes) filter (where err is null), 0) as bigint) as bytes,
             count(err) as errors from broker_event_log where kind = """


@query("broker_write_counters", f"select operation, {TRAFFIC} 'write' group by operation")
def broker_write_counters(i: Inputs) -> DataFrame:
    return metrics.broker_write_counters(i.broker_event_log)


@query("broker_read_counters", f"select {TRAFFIC} 'read'")
def broker_read_counters(i: Inputs) -> DataFrame:
    return metrics.broker_read_counters(i.broker_event_log)


@query(
    "broker_connects",
    f"""select case when err is null then 'success' else 'failure' end as outcome,
              case when err is null then '' else {CONNECT_REASON} end as error_reason, count(*) as value
        from broker_event_log where kind = 'connect' group by 1, 2""",
)
def broker_connects(i: Inputs) -> DataFrame:
    return _filled(metrics.broker_connects(i.broker_event_log))


@query(
    "broker_connect_errors",
    f"""select {CONNECT_REASON} as error_reason, count(*) as value from broker_event_log
        where kind = 'connect' and err is not null group by 1""",
)
def broker_connect_errors(i: Inputs) -> DataFrame:
    return metrics.broker_connect_errors(i.broker_event_log)


def _broker_points_sql() -> str:
    def counter(name: str, unit: str, value: str, where: str, operation="", reason="", outcome="") -> str:
        labels = [operation or "''", reason or "''", outcome or "''"]
        return f"""select '{name}' as metric, '{unit}' as unit, {labels[0]} as operation, {labels[1]} as error_reason,
                   {labels[2]} as outcome, cast({value} as bigint) as value
            from broker_event_log where {where} group by 1, 2, 3, 4, 5"""

    reason = f"case when err is null then '' else {CONNECT_REASON} end"
    ending = "case when err is null then 'success' else 'failure' end"
    sent, failed = "coalesce(sum(nbytes), 0)", "err is not null"
    return " union all ".join(
        [
            counter(metrics.CONNECTS, "1", "count(*)", "kind = 'connect'", reason=reason, outcome=ending),
            counter(metrics.CONNECT_ERRORS, "1", "count(*)", f"kind = 'connect' and {failed}", reason=reason),
            counter(metrics.DISCONNECTS, "1", "count(*)", "kind = 'disconnect'"),
            counter(metrics.WRITE_ERRORS, "1", "count(*)", f"kind = 'write' and {failed}", operation="operation"),
            counter(metrics.WRITE_BYTES, "By", sent, "kind = 'write' and err is null", operation="operation"),
            counter(metrics.READ_ERRORS, "1", "count(*)", f"kind = 'read' and {failed}"),
            counter(metrics.READ_BYTES, "By", sent, "kind = 'read' and err is null"),
        ]
    )


@query(
    "broker_points",
    f"select *, 'kafka' as system, '{NAMESPACE}' as namespace from ({_broker_points_sql()}) p",
)
def broker_points(i: Inputs) -> DataFrame:
    attrs = {"messaging.system": "system", **{c: c for c in ("operation", "error_reason", "outcome", "namespace")}}
    points = metrics.broker_points(i.broker_event_log, NAMESPACE)
    labels = [F.coalesce(F.col("attrs")[key], F.lit("")).alias(name) for key, name in attrs.items()]
    return points.select("metric", "unit", *labels, "value")


@query(
    "broker_dimension_totals",
    f"""select metric, unit, dim, dim_value, cast(sum(value) as bigint) as total from (
            with p as ({_broker_points_sql()})
            select metric, unit, 'messaging.system' as dim, 'kafka' as dim_value, value from p
            union all select metric, unit, 'namespace', '{NAMESPACE}', value from p
            union all select metric, unit, 'operation', operation, value from p where operation <> ''
            union all select metric, unit, 'error_reason', error_reason, value from p where error_reason <> ''
            union all select metric, unit, 'outcome', outcome, value from p where outcome <> '') t
        group by metric, unit, dim, dim_value""",
)
def broker_dimension_totals(i: Inputs) -> DataFrame:
    return metrics.dimension_totals(metrics.broker_points(i.broker_event_log, NAMESPACE))


@query(
    "broker_disconnects",
    "select count(*) as value from broker_event_log where kind = 'disconnect'",
)
def broker_disconnects(i: Inputs) -> DataFrame:
    return metrics.broker_disconnects(i.broker_event_log)
