"""Streaming jobs drained over the stored log, checked against their batch twins."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.histogram import DEFAULT_BOUNDS
from tidelog.operators import compaction
from tidelog.plans.logs import below_ten
from tidelog.plans.registry import query
from tidelog.plans.views import Inputs
from tidelog.sources.shared import new_folder
from tidelog.streaming import delivery, listeners, order, readiness, stateful

NEEDED = ["topic", "part", "roff", "rkey", "k"]


def _stream(i: Inputs, columns: list[str] | None = None) -> DataFrame:
    return i.log_table.read_stream(i.spark).select(*(columns or NEEDED))


def _drained(query_handle):
    query_handle.awaitTermination()
    return query_handle


def _outcome_counts(i: Inputs, folder: str, schema) -> DataFrame:
    done = delivery.results(i.spark, folder, schema)
    counts = done.groupBy("topic", "part").agg(
        F.count(F.when(~F.col("failed"), 1)).alias("processed"),
        F.count(F.when(F.col("failed"), 1)).alias("failed"),
    )
    return counts.join(delivery.positions(i.spark, folder), ["topic", "part"], "left")


COUNTS_SQL = """
select topic, part, count(*) filter (where ok) as processed, count(*) filter (where not ok) as failed,
       {position} as position
from poll_log group by topic, part"""


@query("stream_alod", COUNTS_SQL.format(position="max(roff) filter (where ok) + 1"))
def stream_alod(i: Inputs) -> DataFrame:
    stream, folder = _stream(i), new_folder(i.spark, "alod")
    _drained(delivery.consume_at_least_once(stream, below_ten(), folder, "alod", drain=True))
    return _outcome_counts(i, folder, stream.schema)


@query("stream_amod", COUNTS_SQL.format(position="max(roff) + 1"))
def stream_amod(i: Inputs) -> DataFrame:
    stream, folder = _stream(i), new_folder(i.spark, "amod")
    claims = i.log_table.ranges_of_batch
    _drained(delivery.consume_at_most_once(stream, below_ten(), folder, "amod", drain=True, claims=claims))
    return _outcome_counts(i, folder, stream.schema)


@query(
    "drain_and_stop",
    "select topic, count(*) as num_records from record_log group by topic",
)
def drain_and_stop(i: Inputs) -> DataFrame:
    """Everything present at the start is processed, whatever fails, then the query ends."""
    stream, folder = _stream(i), new_folder(i.spark, "drain")
    job = delivery.consume_at_most_once(
        stream, below_ten(), folder, "drain", drain=True, ordered=False
    )
    if _drained(job).isActive:
        raise RuntimeError("the drained query is still running")
    done = delivery.results(i.spark, folder, stream.schema)
    return done.groupBy("topic").agg(F.count(F.lit(1)).alias("num_records"))


def first_of_each(folder: str, i: Inputs, schema) -> DataFrame:
    """What each micro-batch held of each partition: number of records, first and last offset."""
    done = delivery.results(i.spark, folder, schema)
    return done.groupBy("topic", "part", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("roff").alias("low"), F.max("roff").alias("high")
    )


@query(
    "stream_partition_order",
    """select topic, part, count(*) as num_records, cast(0 as bigint) as out_of_order, cast(0 as bigint) as repeated
       from record_log group by topic, part""",
)
def stream_partition_order(i: Inputs) -> DataFrame:
    """Micro-batches small enough that a partition comes in several, each after those before it."""
    stream = i.log_table.read_stream(i.spark, 1000).select(*NEEDED)
    folder = new_folder(i.spark, "order")
    _drained(delivery.consume_at_least_once(stream, below_ten(), folder, "order", drain=True))
    earlier = Window.partitionBy("topic", "part").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    polls = first_of_each(folder, i, stream.schema).withColumn("before", F.max("high").over(earlier))
    return polls.groupBy("topic", "part").agg(
        F.sum("n").alias("num_records"),
        F.count(F.when(F.col("low") < F.col("before"), 1)).alias("out_of_order"),
        (F.sum("n") - F.max("high") - 1).alias("repeated"),
    )


@query(
    "stream_resume",
    "select topic, part, count(*) as num_records, max(roff) + 1 as reached from record_log group by topic, part",
)
def stream_resume(i: Inputs) -> DataFrame:
    """A run that dies at its third batch, then one that starts anew from the commits: all is handled."""
    stream = i.log_table.read_stream(i.spark, 1000).select(*NEEDED)
    first, second = new_folder(i.spark, "died"), new_folder(i.spark, "resumed")
    step = delivery.at_least_once_step(below_ten(), first)

    def dying(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 2:
            raise RuntimeError("the third batch fails")
        step(batch, batch_id)

    job = stream.writeStream.foreachBatch(dying).option("checkpointLocation", f"{first}/checkpoint")
    try:
        job.trigger(availableNow=True).start().awaitTermination()
    except StreamingQueryException as failure:
        if "the third batch fails" not in str(failure):
            raise
    resumed = delivery.resume(stream, delivery.positions(i.spark, first))
    _drained(delivery.consume_at_least_once(resumed, below_ten(), second, "resumed", drain=True))
    both = [delivery.results(i.spark, folder, stream.schema) for folder in (first, second)]
    rows = both[0].unionByName(both[1]).select("topic", "part", "roff").distinct()
    return rows.groupBy("topic", "part").agg(
        F.count(F.lit(1)).alias("num_records"), (F.max("roff") + 1).alias("reached")
    )


@query(
    "stream_groups",
    """select g.grp, topic, count(*) as num_records from record_log
       cross join (select 'billing' as grp union all select 'search') g group by g.grp, topic""",
)
def stream_groups(i: Inputs) -> DataFrame:
    stream, folder = _stream(i), new_folder(i.spark, "groups")
    jobs = delivery.consume_groups(stream, below_ten(), folder, ["billing", "search"], drain=True)
    counts = []
    for group, job in jobs.items():
        _drained(job)
        done = delivery.results(i.spark, f"{folder}/{group}", stream.schema)
        counts.append(
            done.groupBy(F.lit(group).alias("grp"), "topic").agg(
                F.count(F.lit(1)).alias("num_records")
            )
        )
    return counts[0].unionByName(counts[1])


LATEST = ["topic", "part", "rkey", "rvalue", "roff"]


@query(
    "stream_latest_per_key",
    """select topic, rkey, arg_max(rvalue, roff) as rvalue, max(roff) as roff
       from record_log group by topic, rkey""",
)
def stream_latest_per_key(i: Inputs) -> DataFrame:
    stream, folder = _stream(i, LATEST), new_folder(i.spark, "latest")
    _drained(stateful.follow_latest(stream, folder, "latest", drain=True))
    return stateful.latest_view(i.spark, folder, stream.schema)




@query(
    "stream_counters",
    """select topic, part, count(*) as num_records, cast(sum(length(rvalue)) as bigint) as bytes
       from record_log group by topic, part""",
)
def stream_counters(i: Inputs) -> DataFrame:
    stream, folder = _stream(i, LATEST), new_folder(i.spark, "counters")
    measures = {"num_records": F.count(F.lit(1)), "bytes": F.sum(F.length("rvalue"))}
    by = ["topic", "part"]
    _drained(stateful.count_running(stream, by, measures, folder, "counters", drain=True))
    schema = "topic string, part int, num_records bigint, bytes bigint"
    return stateful.running_totals(i.spark, folder, schema, by)


@query(
    "stream_histogram",
    f"""select topic, part, cast(len(list_filter({[int(b * 1_000_000) for b in DEFAULT_BOUNDS]}, lambda x: x < k * 100000)) as int) as bucket,
               count(*) as bucket_count, cast(sum(k * 100000) as bigint) as sum_us
        from record_log group by all""",
)
def stream_histogram(i: Inputs) -> DataFrame:
    """The histograms of all micro-batches add up to the histogram of the log."""
    stream = _stream(i).withColumn("value_us", F.col("k").cast("bigint") * 100_000)
    folder = new_folder(i.spark, "histogram")
    _drained(stateful.count_buckets(stream, ["topic", "part"], "value_us", folder, "histogram", drain=True))
    return stateful.bucket_totals(i.spark, folder, "topic string, part int", ["topic", "part"])


_LIMITS = [int(b * 1_000_000) for b in DEFAULT_BOUNDS]


@query(
    "stream_histogram_running",
    f"""select topic, count(*) as num, cast(sum(k * 100000) as decimal(38,0)) as sum_us,
               cast(min(k) * 100000 as bigint) as min_us, cast(max(k) * 100000 as bigint) as max_us,
               array_to_string(list_transform(range(0, {len(_LIMITS) + 1}), lambda b: len(list_filter(list(k * 100000), lambda x:
                   (b = 0 or x > {_LIMITS}[b]) and (b = {len(_LIMITS)} or x <= {_LIMITS}[b + 1])))), ',') as bucket_counts
        from record_log group by topic""",
)
def stream_histogram_running(i: Inputs) -> DataFrame:
    """Cumulative histograms over many micro-batches, folded every third, then added up over partitions."""
    stream = i.log_table.read_stream(i.spark, 20_000).select(*NEEDED)
    stream = stream.withColumn("value_us", F.col("k").cast("bigint") * 100_000)
    folder, by = new_folder(i.spark, "running"), ["topic", "part"]
    _drained(stateful.histogram_running(stream, by, "value_us", folder, "running", drain=True, fold_every=3))
    found = stateful.running_histograms(i.spark, folder, "topic string, part int", by)
    merged = stateful.merge_histograms(found, ["topic"])
    return merged.withColumn("bucket_counts", F.array_join("bucket_counts", ","))


@query(
    "stream_counter_deltas",
    """select topic, part, count(*) as num_records, cast(sum(length(rvalue)) as bigint) as bytes
       from record_log group by topic, part""",
)
def stream_counter_deltas(i: Inputs) -> DataFrame:
    """The deltas of all micro-batches add up to the totals."""
    stream, folder = _stream(i, LATEST), new_folder(i.spark, "deltas")
    measures = {"num_records": F.count(F.lit(1)), "bytes": F.sum(F.length("rvalue"))}
    _drained(
        stateful.count_deltas(stream, ["topic", "part"], measures, folder, "deltas", drain=True)
    )
    schema = "topic string, part int, num_records bigint, bytes bigint"
    return stateful.delta_totals(i.spark, folder, schema, ["topic", "part"])


@query(
    "stream_sync_state",
    """select topic, remaining, remaining = 0 as synced,
              case when remaining = 0 then 'synced' else 'not synced: ' || remaining || ' remaining' end as state
       from (select topic, count(*) filter (where part = 3 and topic <> 'name_space-click') as remaining
             from record_log group by topic) r""",
)
def stream_sync_state(i: Inputs) -> DataFrame:
    """Readiness of a reader, from its job's commits, that has not got to one partition of most topics."""
    read = (F.col("part") != 3) | (F.col("topic") == "name_space-click")
    stream, folder = _stream(i).where(read), new_folder(i.spark, "sync")
    job = delivery.consume_at_most_once(
        stream, below_ten(), folder, "sync", drain=True, ordered=False
    )
    _drained(job)
    progress = compaction.sync_progress(i.ends, delivery.positions(i.spark, folder))
    return compaction.sync_state(progress)


@query(
    "stream_readiness",
    """select phase, topic, case phase when 0 then 'not started' when 1 then
              case when left_over = 0 then 'synced' else 'not synced: ' || left_over || ' remaining' end
              else 'synced' end as state
       from (select topic, cast(sum(greatest(end_off - 10, 0)) as bigint) as left_over from partition_offsets group by topic),
            range(4) as t(phase)""",
)
def stream_readiness(i: Inputs) -> DataFrame:
    """A reader before it starts, after a first part of each partition, after the rest, and after new records."""
    stream, latch = _stream(i), readiness.Latch(new_folder(i.spark, "latch"), fold_every=2)
    first, second = new_folder(i.spark, "part"), new_folder(i.spark, "rest")
    topics = i.ends.select("topic").distinct()
    states = []

    def note() -> None:
        now = latch.state(i.spark, topics).select(F.lit(len(states)).cast("bigint").alias("phase"), "topic", "state")
        path = new_folder(i.spark, "phase")
        now.write.parquet(path)
        states.append(i.spark.read.schema("phase bigint, topic string, state string").parquet(path))

    note()
    some = stream.where("roff < 10")
    _drained(delivery.consume_at_most_once(some, below_ten(), first, "part", drain=True, ordered=False))
    reached = delivery.positions(i.spark, first)
    latch.observe(i.ends, reached, 0)
    note()
    rest = delivery.resume(stream, reached)
    _drained(delivery.consume_at_most_once(rest, below_ten(), second, "rest", drain=True, ordered=False))
    latch.observe(i.ends, delivery.positions(i.spark, second, reached).unionByName(reached).groupBy("topic", "part").agg(F.max("position").alias("position")), 1)
    note()
    grown = i.ends.withColumn("end_off", F.col("end_off") + 1000)
    latch.observe(grown, reached, 2)
    note()
    return states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[3])


@query(
    "stream_order_state",
    """select topic, part, count(*) as num_records, max(roff) + 1 as next, cast(0 as bigint) as repeated
       from record_log group by topic, part""",
)
def stream_order_state(i: Inputs) -> DataFrame:
    """Each partition goes on where it stood, over many micro-batches, by its state."""
    stream, folder = i.log_table.read_stream(i.spark, 20_000), new_folder(i.spark, "checked")
    _drained(order.check_order(stream, folder, "order_state", drain=True))
    seen = order.checked(i.spark, folder).groupBy("topic", "part")
    return seen.agg(
        F.sum("num_records").alias("num_records"), F.max("next").alias("next"), F.sum("repeated").alias("repeated")
    )


@query(
    "stream_dedup",
    """select topic, part, count(*) as num_records, max(roff) as last_off, cast(1 as bigint) as intervals
       from record_log group by topic, part""",
)
def stream_dedup(i: Inputs) -> DataFrame:
    """Everything twice, at different times: larger micro-batches of one copy, smaller ones of the other."""
    twice = [i.log_table.read_stream(i.spark, size).select(*NEEDED) for size in (200_000, 20_000)]
    stream, folder = twice[0].unionByName(twice[1]), new_folder(i.spark, "dedup")
    _drained(order.deduplicate(stream, folder, "dedup", drain=True, fold_every=2))
    once = order.deduplicated(i.spark, folder, stream.schema).groupBy("topic", "part")
    known = delivery.intervals(i.spark, folder).groupBy("topic", "part").agg(F.count(F.lit(1)).alias("intervals"))
    return once.agg(F.count(F.lit(1)).alias("num_records"), F.max("roff").alias("last_off")).join(known, ["topic", "part"])


@query(
    "stream_batch_listener",
    """select count(*) as num_records, cast(sum(length(rvalue)) as bigint) as bytes, cast(0 as bigint) as unlike
       from record_log""",
)
def stream_batch_listener(i: Inputs) -> DataFrame:
    """What a listener was told of each batch; ``unlike`` counts batches that were not reported as they were."""
    stream = listeners.observed(i.log_table.read_stream(i.spark, 20_000).select(*NEEDED, "rvalue"))
    folder = new_folder(i.spark, "listened")
    told = listeners.reports_of(
        i.spark,
        lambda name: delivery.consume_at_most_once(
            stream, below_ten(), folder, name, drain=True, ordered=False, claims=i.log_table.ranges_of_batch
        ),
    )
    done = delivery.results(i.spark, folder, stream.schema).groupBy("batch_id")
    real = done.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("rvalue")).alias("b"))
    both = told.join(real, "batch_id", "full")
    same = (F.col("n") == F.col("num_records")) & (F.col("b") == F.col("bytes"))
    return both.agg(
        F.sum("num_records").alias("num_records"),
        F.sum("bytes").alias("bytes"),
        F.count(F.when(~F.coalesce(same, F.lit(False)), 1)).alias("unlike"),
    )
