"""Queries over the record log: scans, sinks, envelope, delivery, compaction, user code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import headers as hdr
from tidelog.functions.naming import add_namespace, in_namespace, strip_namespace
from tidelog.functions.routing import partition_by_murmur2, partition_for_key
from tidelog.operators import compaction, delivery, processing
from tidelog.operators.metrics import message_delay
from tidelog.plans.registry import query
from tidelog.plans.sql import PRODUCE_REASON, bare
from tidelog.plans.views import GROUPS, MAX_POLL, NAMESPACE, PARTS, Inputs
from tidelog.functions.labels import produce_error_reason
from tidelog.sources import scan
from tidelog.sources.envelope import to_envelope, to_record
from tidelog.sources.log_table import choose_codec, write_log
from tidelog.sources.shared import new_folder


def num_records() -> Column:
    return F.count(F.lit(1)).alias("num_records")


# ---- scans -------------------------------------------------------------------------


@query(
    "scan_topics",
    """select topic, part, roff, rkey, rvalue from record_log
       where topic in ('name_space-click', 'name_space-view')""",
)
def scan_topics(i: Inputs) -> DataFrame:
    found = scan.scan_topics(i.record_log, ["click", "view"], NAMESPACE)
    return found.select("topic", "part", "roff", "rkey", "rvalue")


@query(
    "scan_topics_regex",
    """select topic, part, count(*) as num_records, max(roff) as last_off from record_log
       where regexp_matches(topic, 'name_space-click|gnu') or regexp_matches(topic, 'name_space-p.*e$')
       group by topic, part""",
)
def scan_topics_regex(i: Inputs) -> DataFrame:
    found = scan.scan_topics_regex(i.record_log, ["click|gnu", "p.*e$"], NAMESPACE)
    return found.groupBy("topic", "part").agg(num_records(), F.max("roff").alias("last_off"))


@query(
    "replay_to_hwm",
    """select r.topic, r.part, r.roff, r.rkey, r.rvalue, o.end_off as hwm
       from record_log r join partition_offsets o on o.topic = r.topic and o.part = r.part
       where r.topic = 'name_space-click' and r.roff < o.end_off""",
)
def replay_to_hwm(i: Inputs) -> DataFrame:
    rows = scan.replay(i.record_log, i.ends, f"{NAMESPACE}-click")
    return rows.select("topic", "part", "roff", "rkey", "rvalue", "hwm")


@query(
    "bounded_polls",
    """select topic, part, poll_id, count(*) as num_records, min(roff) as first_off, max(roff) as last_off
       from poll_log group by topic, part, poll_id""",
)
def bounded_polls(i: Inputs) -> DataFrame:
    return delivery.fetches(scan.with_polls(i.record_log, MAX_POLL))


@query(
    "consumer_groups",
    """select g.grp, topic, part, count(*) as num_records from record_log
       cross join (select distinct grp from committed_offsets) g group by g.grp, topic, part""",
)
def consumer_groups(i: Inputs) -> DataFrame:
    return scan.group_counts(i.routed, list(GROUPS))


def _some_commits(i: Inputs) -> DataFrame:
    """The commits without those of one group in one partition number, as if it were new, and
    without all topics but one of another group."""
    few = "not (grp = 'consumer2' and part = 1) and (grp <> 'consumer4' or topic like '%click')"
    return i.committed_offsets.where(few)


SOME_COMMITS = """(select g.grp, o.topic, o.part, coalesce(c.committed, -1) as committed
    from (select distinct grp, topic from committed_offsets where grp <> 'consumer4' or topic like '%click') g
    join partition_offsets o on o.topic = g.topic
    left join committed_offsets c on c.grp = g.grp and c.topic = o.topic and c.part = o.part
        and not (c.grp = 'consumer2' and c.part = 1))"""


def _resumed(i: Inputs) -> DataFrame:
    table = i.log_table
    return scan.from_commit(table.read_segments(i.spark), _some_commits(i), manifest=table.manifest(i.spark))


@query(
    "resume_from_commit",
    f"""select c.grp, r.topic, r.part, min(r.roff) as first_off, count(*) as num_records
       from record_log r join {SOME_COMMITS} c on c.topic = r.topic and c.part = r.part
       where r.roff >= c.committed group by c.grp, r.topic, r.part""",
)
def resume_from_commit(i: Inputs) -> DataFrame:
    return _resumed(i).groupBy("grp", "topic", "part").agg(F.min("roff").alias("first_off"), num_records())


@query(
    "unread_records",
    f"""select c.grp, r.topic, r.part, r.roff, r.rkey
       from record_log r join {SOME_COMMITS} c on c.topic = r.topic and c.part = r.part
       where r.roff >= c.committed""",
)
def unread_records(i: Inputs) -> DataFrame:
    return _resumed(i).select("grp", "topic", "part", "roff", "rkey")


# ---- sinks -------------------------------------------------------------------------

ROUTE = "cast(cast('0x' || substr(md5({key}), 1, 8) as bigint) % 4 as int)"


@query(
    "produce_records",
    f"""select topic, part,
              cast(row_number() over (partition by topic, part order by ts_us, event_id) - 1 as bigint) as roff,
              rkey, rvalue, 'b' as header_a, 'd' as header_c
        from (select topic, {ROUTE.format(key='rkey')} as part, rkey, rvalue, ts_us, event_id from record_log) r""",
)
def produce_records(i: Inputs) -> DataFrame:
    metadata = F.create_map(F.lit("c"), F.lit("d"), F.lit("a"), F.lit("b"))
    envelope = to_envelope(i.event_records, NAMESPACE, PARTS, metadata)
    written = write_log(envelope, new_folder(i.spark, "produced"), ["ts_us", "event_id"])
    back = written.read(i.spark).withColumn("meta", hdr.headers_to_map(F.col("headers")))
    return back.select(
        "topic",
        "part",
        "roff",
        "rkey",
        "rvalue",
        F.col("meta")["a"].alias("header_a"),
        F.col("meta")["c"].alias("header_c"),
    )


@query(
    "fan_out_by_topic",
    """select topic, count(distinct part) as parts, count(*) as num_records
       from record_log group by topic""",
)
def fan_out_by_topic(i: Inputs) -> DataFrame:
    per_part = i.record_log.groupBy("topic", "part").agg(F.count(F.lit(1)).alias("n"))
    return per_part.groupBy("topic").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("num_records")
    )


@query(
    "route_by_key",
    f"""select topic, rkey, coalesce({ROUTE.format(key='nullif(rkey, \'\')')}, cast(roff % 4 as int)) as route,
              count(*) as num_records
        from (select topic, roff, case when k % 3 = 0 then '' else rkey end as rkey from record_log) r
        group by topic, rkey, route""",
)
def route_by_key(i: Inputs) -> DataFrame:
    """A third of the records have no key."""
    keyed = i.record_log.withColumn("rkey", F.when(F.col("k") % 3 != 0, F.col("rkey")))
    route = partition_for_key(F.col("rkey"), F.col("roff"), PARTS)
    return keyed.groupBy(
        "topic", F.coalesce("rkey", F.lit("")).alias("rkey"), route.alias("route")
    ).agg(num_records())


MURMUR2 = """
    select *, xor(h4, h4 >> 15) as hash from (select *, (xor(h3, h3 >> 13) * 1540483477) & 4294967295 as h4 from (
    select *, case when size % 4 = 0 then h2 else ((xor(h2, coalesce(try_cast('0x' || substr(digits, 2 * (size // 4 * 4) + 1, 2) as bigint), 0)
            + 256 * coalesce(try_cast('0x' || substr(digits, 2 * (size // 4 * 4) + 3, 2) as bigint), 0)
            + 65536 * coalesce(try_cast('0x' || substr(digits, 2 * (size // 4 * 4) + 5, 2) as bigint), 0))) * 1540483477) & 4294967295 end as h3
    from (select *, list_reduce(list_prepend(xor(2538058380, size), list_transform(words,
            lambda w: (xor((w * 1540483477) & 4294967295, ((w * 1540483477) & 4294967295) >> 24) * 1540483477) & 4294967295)),
            lambda h, w: xor((h * 1540483477) & 4294967295, w)) as h2
    from (select *, list_transform(range(0, size // 4), lambda n: cast('0x' || substr(digits, 8 * n + 7, 2)
            || substr(digits, 8 * n + 5, 2) || substr(digits, 8 * n + 3, 2) || substr(digits, 8 * n + 1, 2) as bigint)) as words
    from (select *, hex(key) as digits, cast(strlen(key) as bigint) as size from keys)))))"""


@query(
    "route_like_a_client",
    f"""select key, cast((hash & 2147483647) % 12 as int) as place, num_records
        from ({MURMUR2.replace("from keys", "from (select rkey || substr('abcdefgh', 1, k % 9) as key, count(*) as num_records from record_log group by key) k")}) h""",
)
def route_like_a_client(i: Inputs) -> DataFrame:
    """Keys of all lengths where the usual log client would put them."""
    key = F.concat("rkey", F.substr(F.lit("abcdefgh"), F.lit(1), F.col("k") % 9)).alias("key")
    counted = i.routed.select(key).groupBy("key").agg(num_records())
    return counted.withColumn("place", partition_by_murmur2(F.col("key"), 12))


@query(
    "custom_partitioner",
    """select topic, cast(k % 3 as int) as part, count(*) as num_records
       from record_log group by topic, k % 3""",
)
def custom_partitioner(i: Inputs) -> DataFrame:
    routed = to_envelope(i.event_records, NAMESPACE, PARTS, partitioner=F.col("k") % 3)
    return routed.groupBy("topic", "part").agg(num_records())


@query(
    "sink_compression",
    """select 'zstd' as codec, topic, count(*) as num_records, cast(sum(length(rvalue)) as bigint) as raw_bytes
       from record_log group by topic""",
)
def sink_compression(i: Inputs) -> DataFrame:
    codec = choose_codec("zstd,none")
    path = new_folder(i.spark, "codec")
    rows = i.record_log.select("part", "roff", "rkey", "rvalue", "topic")
    rows.write.option("compression", codec).partitionBy("topic").parquet(path)
    back = i.spark.read.schema(rows.schema).parquet(path)
    # Spark names files by the codec that they were written with.
    used = F.regexp_extract("_metadata.file_name", "[.]([a-z0-9_]+)[.]parquet$", 1)
    return back.groupBy(used.alias("codec"), "topic").agg(
        num_records(), F.sum(F.length("rvalue")).alias("raw_bytes")
    )


@query(
    "delivery_report",
    f"""select p.topic, p.part, p.roff, case when f.err is null then 'success' else 'failure' end as outcome,
              coalesce(f.reason, '') as reason
        from poll_log p left join (select topic, part, roff, err, {PRODUCE_REASON} as reason from produce_failure_log) f
          on f.topic = p.topic and f.part = p.part and f.roff = p.roff""",
)
def delivery_report(i: Inputs) -> DataFrame:
    reason = F.when(
        F.col("err").isNotNull(), produce_error_reason(F.col("err"), F.col("is_broker_err"))
    )
    return processing.delivery_report(i.produce_log.withColumn("reason", reason), "err", "reason")


# ---- names and envelope ------------------------------------------------------------


@query(
    "add_namespace",
    f"""select {bare()} as topic, topic as wire_topic, count(*) as num_records
        from record_log group by 1, 2""",
)
def add_namespace_query(i: Inputs) -> DataFrame:
    wire = add_namespace(F.col("topic"), NAMESPACE).alias("wire_topic")
    return i.event_records.groupBy("topic").agg(num_records()).select("topic", wire, "num_records")


@query(
    "strip_namespace",
    f"""select topic, {bare()} as bare_topic, count(*) as num_records
        from bare_and_foreign group by topic""",
)
def strip_namespace_query(i: Inputs) -> DataFrame:
    counts = i.bare_and_foreign.groupBy("topic").agg(num_records())
    return counts.withColumn("bare_topic", strip_namespace(F.col("topic"), NAMESPACE))


@query(
    "filter_namespace",
    """select topic, count(*) as num_records from bare_and_foreign
       where starts_with(topic, 'name_space-') group by topic""",
)
def filter_namespace(i: Inputs) -> DataFrame:
    return in_namespace(i.bare_and_foreign, NAMESPACE).groupBy("topic").agg(num_records())


@query("to_record", f"select {bare()} as topic, part, rkey, rvalue from record_log")
def to_record_query(i: Inputs) -> DataFrame:
    return to_record(i.routed, NAMESPACE)


def _header(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").cast("binary").alias("value"))


def _with_headers(i: Inputs) -> DataFrame:
    """Records with three headers, two of them with the same key."""
    kind = strip_namespace(F.col("topic"), NAMESPACE)
    return i.routed.withColumn(
        "headers",
        F.array(
            _header("user", F.col("rkey")), _header("kind", kind), _header("user", F.col("k"))
        ),
    )


@query(
    "headers_to_map",
    """select event_id, 'user' as key, cast(k as varchar) as value from record_log
       union all select event_id, 'kind', substr(topic, 12) from record_log""",
)
def headers_to_map(i: Inputs) -> DataFrame:
    return _with_headers(i).select(
        "event_id", F.explode(hdr.headers_to_map(F.col("headers"))).alias("key", "value")
    )


@query(
    "map_to_headers",
    """select event_id, cast(0 as int) as pos, 'kind' as key, substr(topic, 12) as value from record_log
       union all select event_id, 1, 'user', rkey from record_log""",
)
def map_to_headers(i: Inputs) -> DataFrame:
    metadata = F.create_map(
        F.lit("user"), F.col("rkey"), F.lit("kind"), strip_namespace(F.col("topic"), NAMESPACE)
    )
    listed = i.routed.select(
        "event_id", F.posexplode(hdr.map_to_headers(metadata)).alias("pos", "header")
    )
    return listed.select(
        "event_id", "pos", "header.key", F.col("header.value").cast("string").alias("value")
    )


@query(
    "enrich_metadata",
    """select event_id, 'user' as key, cast(k as varchar) as value from record_log
       union all select event_id, 'kind', substr(topic, 12) from record_log
       union all select event_id, 'trace', cast(event_id as varchar) from record_log""",
)
def enrich_metadata(i: Inputs) -> DataFrame:
    start = F.create_map(
        F.lit("user"), F.col("rkey"), F.lit("kind"), strip_namespace(F.col("topic"), NAMESPACE)
    )
    replaced = hdr.enrich(start, F.lit("user"), F.col("k").cast("string"))
    full = hdr.enrich(replaced, F.lit("trace"), F.col("event_id").cast("string"))
    return i.routed.select("event_id", F.explode(full).alias("key", "value"))


@query(
    "header_dimensions",
    """select event_id, 'messaging.system' as key, 'kafka' as value from record_log
       union all select event_id, 'topic', topic from record_log
       union all select event_id, 'outcome', 'as-' || k from record_log
       union all select event_id, 'user', rkey from record_log
       union all select event_id, 'namespace', 'name_space' from record_log
       union all select event_id, 'tier', case when k % 2 = 0 then 'even' else 'odd' end from record_log""",
)
def header_dimensions(i: Inputs) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    fixed = F.create_map(
        F.lit("messaging.system"), F.lit("kafka"), F.lit("topic"), F.col("topic"), F.lit("outcome"), F.lit("success")
    )
    metadata = F.create_map(
        F.lit("traceparent"), text("event_id"),
        F.lit("outcome"), F.concat(F.lit("as-"), text("k")),
        F.lit("user"), F.col("rkey"),
        F.lit("tier"), F.lit("from-header"),
    )
    attributes = F.create_map(F.lit("tier"), F.when(F.col("k") % 2 == 0, "even").otherwise("odd"))
    dims = hdr.record_dimensions(fixed, metadata, attributes, NAMESPACE)
    return i.routed.select("event_id", F.explode(dims).alias("key", "value"))


@query(
    "topic_attribute_fn",
    """select r.topic, d.key, d.value
       from (select distinct topic from record_log) r
       join (select 'name_space-' || topic as topic, 'team' as key, team as value from topic_dim
             union all select 'name_space-' || topic, 'tier', case when topic = 'view' then 'single' else tier end from topic_dim
             union all select 'name_space-error', 'tier', 'single') d on d.topic = r.topic""",
)
def topic_attribute_fn(i: Inputs) -> DataFrame:
    """Both forms, on distinct topics: the single pair replaces the tier of two topics."""
    dim = i.topic_dim.withColumn("topic", add_namespace(F.col("topic"), NAMESPACE))
    topics = i.routed.select("topic").distinct().join(dim, "topic", "left")
    many = F.when(
        F.col("team").isNotNull(),
        F.create_map(F.lit("team"), F.col("team"), F.lit("tier"), F.col("tier")),
    )
    pair = F.when(
        F.col("topic").isin(f"{NAMESPACE}-view", f"{NAMESPACE}-error"), F.lit("single")
    ).otherwise(F.col("tier"))
    single = F.struct(F.lit("tier").alias("key"), pair.alias("value"))
    return topics.select("topic", F.explode(hdr.topic_attributes(many, single)).alias("key", "value"))


@query("message_delay", "select topic, part, roff, delay_us from message_delay")
def message_delay_query(i: Inputs) -> DataFrame:
    polls = i.poll_log.select("topic", "part", "poll_id", "roff", "ts_us")
    return message_delay(polls).select("topic", "part", "roff", "delay_us")


# ---- delivery ----------------------------------------------------------------------

FETCHES = """(select topic, part, poll_id, count(*) as num_records from poll_log group by topic, part, poll_id)"""


@query(
    "skip_empty",
    """select topic, part, poll_id, sum(case when ok then 0 else 1 end)::bigint as num_records
       from poll_log group by topic, part, poll_id having sum(case when ok then 0 else 1 end) > 0""",
)
def skip_empty(i: Inputs) -> DataFrame:
    failed = F.count(F.when(~F.col("ok"), F.lit(1))).alias("num_records")
    return delivery.skip_empty(i.poll_log.groupBy("topic", "part", "poll_id").agg(failed))


def _owners(i: Inputs) -> DataFrame:
    return i.members.where(F.col("grp") == "consumer1")


@query(
    "dispatch_partitions",
    f"""select f.topic, f.part, f.poll_id, m.client_id, f.num_records
        from {FETCHES} f join members m on m.topic = f.topic and m.part = f.part and m.grp = 'consumer1'""",
)
def dispatch_partitions(i: Inputs) -> DataFrame:
    sent = delivery.dispatch(delivery.fetches(i.poll_log), _owners(i))
    return sent.select("topic", "part", "poll_id", "client_id", "num_records")


@query(
    "revoked_data_loss",
    f"""select {bare('f.topic')} as topic, f.part, f.poll_id, o.end_off as hwm, f.num_records
        from {FETCHES} f left join partition_offsets o on o.topic = f.topic and o.part = f.part
            and o.topic <> 'name_space-view'
        where not exists (select 1 from members m where m.grp = 'consumer1' and m.topic = f.topic and m.part = f.part)""",
)
def revoked_data_loss(i: Inputs) -> DataFrame:
    fetched = delivery.fetches(i.poll_log)
    known = i.ends.where(F.col("topic") != f"{NAMESPACE}-view")  # one topic's ends are missing
    return delivery.revoked_data_loss(fetched, _owners(i), known, "amod", NAMESPACE)


@query(
    "produced_vs_consumed",
    """select topic, part, produced, consumed, produced - consumed as diff, consumed >= produced as complete
       from (select topic, part, count(*) as produced, count(*) filter (where ok) as consumed
             from poll_log group by topic, part) t""",
)
def produced_vs_consumed(i: Inputs) -> DataFrame:
    consumed = delivery.fetches(i.poll_log.where("ok"))
    return delivery.produced_vs_consumed(i.batch_log, consumed)


@query(
    "alod_commit_offsets",
    """select topic, part, poll_id, max(roff) filter (where ok) + 1 as commit from poll_log
       group by topic, part, poll_id having max(roff) filter (where ok) is not null""",
)
def alod_commit_offsets(i: Inputs) -> DataFrame:
    return delivery.alod_commits(i.poll_log)


@query(
    "alod_commit_offsets_strict",
    """select topic, part, poll_id, coalesce(min(roff) filter (where not ok), max(roff) + 1) as commit
       from poll_log group by topic, part, poll_id
       having coalesce(min(roff) filter (where not ok), max(roff) + 1) > min(roff)""",
)
def alod_commit_offsets_strict(i: Inputs) -> DataFrame:
    return delivery.alod_commits(i.poll_log, strict=True)


@query(
    "amod_commit_offsets",
    """select topic, part, poll_id, max(roff) + 1 as commit from poll_log
       group by topic, part, poll_id""",
)
def amod_commit_offsets(i: Inputs) -> DataFrame:
    return delivery.amod_commits(i.poll_log)


@query(
    "lost_records",
    """select 'amod' as delivery, topic, part, count(*) as lost from poll_log where not ok group by topic, part
       union all
       select 'alod', p.topic, p.part, count(*)
       from poll_log p join (select topic, part, max(roff) + 1 as position from poll_log where ok group by topic, part) c
         on c.topic = p.topic and c.part = p.part
       where not p.ok and p.roff < c.position group by p.topic, p.part""",
)
def lost_records(i: Inputs) -> DataFrame:
    partitions = i.log_table.partitions
    lost = [
        delivery.lost_records(i.poll_log, partitions, d).select(
            F.lit(d).alias("delivery"), "topic", "part", "lost"
        )
        for d in ("amod", "alod")
    ]
    return lost[0].unionByName(lost[1])


@query(
    "ordering_check",
    """select topic, part, roff, cast(k as bigint) as seq, cast(prev as bigint) as prev_seq
       from (select topic, part, roff, k, lag(k) over (partition by topic, part order by roff) as prev from record_log) r
       where k <> prev + 1""",
)
def ordering_check(i: Inputs) -> DataFrame:
    """``k`` is random, so it is out of sequence almost everywhere."""
    return delivery.ordering_violations(i.record_log, F.col("k"), block=1_000)


@query(
    "ordering_check_by_key",
    """select topic, part, rkey, roff, seq, prev as prev_seq
       from (select topic, part, rkey, roff, seq, lag(seq) over (partition by topic, part, rkey order by roff) as prev
             from (select *, (event_id - event_id % 100) / 100 as seq from record_log) s) r
       where seq <> prev + 1""".replace("(event_id - event_id % 100) / 100", "cast((event_id - event_id % 100) / 100 as bigint)"),
)
def ordering_check_by_key(i: Inputs) -> DataFrame:
    seq = F.expr("event_id div 100")
    return delivery.ordering_violations(i.record_log, seq, ["topic", "part", "rkey"], block=1_000)


@query(
    "consume_rate",
    """select topic, count(*) as num_records, max(ts_us) - min(ts_us) as elapsed_us,
              count(*) / ((max(ts_us) - min(ts_us)) / 1e6::double) as per_second
       from record_log group by topic""",
)
def consume_rate(i: Inputs) -> DataFrame:
    return delivery.consume_rate(i.routed, ["topic"])


@query(
    "redelivery_dedup",
    """select r.topic, r.part, count(*) as num_records, max(r.roff) as last_off from record_log r
       group by r.topic, r.part""",
)
def redelivery_dedup(i: Inputs) -> DataFrame:
    """Everything, then all that a restarted group gets again."""
    log = i.record_log.select("topic", "part", "roff", "rkey")
    committed = i.committed_offsets.where(F.col("grp") == "consumer2")
    table = i.log_table
    again = scan.from_commit(table.read_segments(i.spark), committed, manifest=table.manifest(i.spark)).select(*log.columns)
    once = delivery.redelivery_dedup(log.unionByName(again))
    return once.groupBy("topic", "part").agg(num_records(), F.max("roff").alias("last_off"))


# ---- compaction --------------------------------------------------------------------


@query(
    "latest_per_key",
    """select topic, rkey, arg_max(rvalue, roff) as rvalue, max(roff) as roff
       from record_log group by topic, rkey""",
)
def latest_per_key(i: Inputs) -> DataFrame:
    return compaction.latest_per_key(i.record_log)


@query(
    "sync_progress",
    """select c.grp, c.topic, cast(sum(o.end_off - greatest(c.committed, 0)) as bigint) as remaining,
              sum(o.end_off - greatest(c.committed, 0)) = 0 as synced
       from committed_offsets c join partition_offsets o on o.topic = c.topic and o.part = c.part
       group by c.grp, c.topic""",
)
def sync_progress(i: Inputs) -> DataFrame:
    positions = i.committed_offsets.withColumnRenamed("committed", "position")
    return compaction.sync_progress(i.ends, positions, by=["grp"])


@query(
    "readiness_history",
    """select grp, topic, nth as at, remaining,
              case when min(remaining) over w = 0 then 'synced' when remaining is null then 'not started'
                   else 'not synced: ' || remaining || ' remaining' end as state
       from (select c.grp, o.topic, m.nth, case when m.nth >= length(c.grp) - length('consumer')
                    then cast(sum(greatest(o.end_off * m.nth // 8 - greatest(c.committed, 0) * least(m.nth, 4) // 4, 0)) as bigint)
                    end as remaining
             from partition_offsets o join committed_offsets c on c.topic = o.topic and c.part = o.part, range(1, 9) m(nth)
             group by c.grp, o.topic, m.nth) seen
       window w as (partition by grp, topic order by nth)""",
)
def readiness_history(i: Inputs) -> DataFrame:
    """Groups that read while their topics grow: each at one of eight times, some from the second on."""
    times = F.explode(F.array(*[F.lit(n).cast("bigint") for n in range(1, 9)])).alias("at")
    both = i.committed_offsets.join(i.ends, ["topic", "part"]).select("*", times)
    left = F.expr("greatest(end_off * at div 8 - greatest(committed, 0) * least(at, 4) div 4, 0)")
    seen = both.groupBy("grp", "topic", "at").agg(F.sum(left).alias("left"))
    started = F.col("at") >= F.length("grp") - len("consumer")
    observed = seen.select("grp", "topic", "at", F.when(started, F.col("left")).alias("remaining"))
    return compaction.readiness_history(observed, "at", ["grp"]).drop("started", "synced")


# ---- user functions ----------------------------------------------------------------


def below_ten():
    """The user function of the examples: a record with ``k`` below 10 fails."""

    def process(batch):
        return [f"k is {k}" if k < 10 else None for k in batch["k"]]

    return process


@query(
    "process_records",
    """select topic, part, count(*) filter (where ok) as processed, count(*) filter (where not ok) as failed
       from poll_log group by topic, part""",
)
def process_records(i: Inputs) -> DataFrame:
    rows = i.routed.select("topic", "part", "rvalue", "k")
    done = processing.process_records(rows, below_ten())
    return done.groupBy("topic", "part").agg(
        F.count(F.when(F.col("error").isNull(), 1)).alias("processed"),
        F.count("error").alias("failed"),
    )


@query(
    "dead_letter",
    """select topic, part, roff, rkey, 'k is ' || k as error from poll_log where not ok""",
)
def dead_letter(i: Inputs) -> DataFrame:
    rows = i.record_log.select("topic", "part", "roff", "rkey", "k")
    return processing.dead_letters(processing.process_records(rows, below_ten())).drop("k")


@query(
    "process_batch",
    "select count(*) as num_records, cast(0 as bigint) as failed_batches from record_log",
)
def process_batch(i: Inputs) -> DataFrame:
    def process(batches):
        for batch in batches:
            batch["rvalue"].str.len().sum()

    done = processing.process_batches(i.routed.select("topic", "part", "rvalue"), process)
    return done.agg(
        F.sum("num_records").alias("num_records"), F.count("error").alias("failed_batches")
    )


@query(
    "process_polls",
    """select topic, part, poll_id, count(*) as num_records,
              case when arg_min(k, roff) >= 10 then cast(sum(length(rvalue)) as bigint) end as value_length,
              case when arg_min(k, roff) < 10 then 'the first k is ' || arg_min(k, roff) end as error
       from poll_log group by topic, part, poll_id""",
)
def process_polls(i: Inputs) -> DataFrame:
    """What the function returns for each poll; one that begins with a small ``k`` fails alone."""

    def process(poll):
        if poll["k"].iloc[0] < 10:
            raise ValueError(f"the first k is {poll['k'].iloc[0]}")
        return int(poll["rvalue"].str.len().sum())

    rows = i.poll_log.select("topic", "part", "poll_id", "roff", "rvalue", "k")
    return processing.process_polls(rows, process, "bigint").withColumnRenamed("result", "value_length")


# ---- the larger log ----------------------------------------------------------------


def _line_log(i: Inputs) -> DataFrame:
    return i.line_table.read(i.spark)


def _line_polls(i: Inputs) -> DataFrame:
    return scan.with_polls(_line_log(i)).withColumn("ok", F.col("k") >= 10)


@query(
    "lines_latest_per_key",
    """select topic, rkey, arg_max(rvalue, roff) as rvalue, max(roff) as roff
       from line_log group by topic, rkey""",
)
def lines_latest_per_key(i: Inputs) -> DataFrame:
    return compaction.latest_per_key(_line_log(i))


@query(
    "lines_alod_commit_offsets",
    """select topic, part, poll_id, max(roff) filter (where ok) + 1 as commit from line_polls
       group by topic, part, poll_id having max(roff) filter (where ok) is not null""",
)
def lines_alod_commit_offsets(i: Inputs) -> DataFrame:
    return delivery.alod_commits(_line_polls(i))


@query(
    "lines_lost_records",
    """select p.topic, p.part, count(*) as lost
       from line_polls p join (select topic, part, max(roff) + 1 as position from line_polls where ok group by topic, part) c
         on c.topic = p.topic and c.part = p.part
       where not p.ok and p.roff < c.position group by p.topic, p.part""",
)
def lines_lost_records(i: Inputs) -> DataFrame:
    return delivery.lost_records(_line_polls(i), i.line_table.partitions)


@query(
    "lines_ordering_check",
    """select topic, part, count(*) as violations
       from (select topic, part, k, lag(k) over (partition by topic, part order by roff) as prev from line_log) r
       where k <> prev + 1 group by topic, part""",
)
def lines_ordering_check(i: Inputs) -> DataFrame:
    found = delivery.ordering_violations(_line_log(i), F.col("k"), block=5_000)
    return found.groupBy("topic", "part").agg(F.count(F.lit(1)).alias("violations"))
