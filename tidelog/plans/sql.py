"""The log-shaped views in DuckDB's SQL, and helpers to write checks with them."""

from __future__ import annotations

from collections.abc import Sequence

VIEWS = """
with record_log as (
  select 'name_space-' || event_type as topic,
         cast(user_id % 4 as int) as part,
         cast(row_number() over (partition by event_type, user_id % 4 order by ts, event_id) - 1 as bigint) as roff,
         cast(user_id as varchar(20)) as rkey,
         props as rvalue,
         epoch_us(ts) as ts_us,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
         event_id
  from events
), poll_log as (
  select topic, part, roff, rkey, rvalue, ts_us, k, event_id,
         cast((roff - roff % 50) / 50 as bigint) as poll_id,
         k >= 10 as ok
  from record_log
), batch_log as (
  select topic, part, poll_id,
         cast((poll_id + part) % 6 as int) as codec_id,
         count(*) as num_records,
         cast(sum(length(rvalue)) as bigint) as uncompressed_bytes,
         cast(sum(case when (poll_id + part) % 6 = 0 then length(rvalue) else length(rvalue) - 2 end) as bigint) as compressed_bytes,
         max(ts_us) as read_us
  from poll_log
  group by topic, part, poll_id
), produce_failure_log as (
  select topic, part, roff, rkey, k,
         case k % 4 when 0 then 'deadline_exceeded' when 1 then 'canceled'
                    when 2 then 'UNKNOWN_TOPIC_OR_PARTITION' else 'boom' end as err,
         k % 4 = 2 as is_broker_err
  from poll_log
  where not ok
), broker_event_log as (
  select event_id,
         case event_type when 'click' then 'write' when 'view' then 'read' when 'error' then 'connect'
                         when 'signup' then 'throttle' else 'disconnect' end as kind,
         case k % 4 when 0 then 'ApiVersions' when 1 then 'Metadata' when 2 then 'Produce' else 'Fetch' end as operation,
         cast(k * 100 as bigint) as nbytes,
         cast(k * 1000 as bigint) as wait_us,
         cast(event_id % 1000 as bigint) as io_us,
         case when k >= 10 then null when k % 3 = 0 then 'canceled' when k % 3 = 1 then 'deadline_exceeded' else 'boom' end as err
  from (select event_id, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events) e
), partition_offsets as (
  select topic, part,
         cast((max(roff) + 1 - (max(roff) + 1) % 10) / 10 as bigint) as start_off,
         max(roff) + 1 as end_off,
         case when topic = 'name_space-view' and part = 1 then 'OFFSET_OUT_OF_RANGE' end as start_err,
         case when topic = 'name_space-signup' and part = 2 then 'UNKNOWN_TOPIC_OR_PARTITION' end as end_err
  from record_log
  group by topic, part
), committed_offsets as (
  select g.grp, o.topic, o.part,
         case when g.n = 3 and o.part = 0 then cast(-1 as bigint)
              else cast((o.end_off * g.n - (o.end_off * g.n) % 4) / 4 as bigint) end as committed
  from partition_offsets o
  cross join (select 'consumer1' as grp, 1 as n union all select 'consumer2', 2 union all select 'consumer3', 3 union all select 'consumer4', 4) g
), members as (
  select grp, topic, part, 'client-' || cast(part % 2 as varchar(5)) as client_id
  from committed_offsets
  where part <> 3
), monitor as (
  select 'click' as topic, '' as regex, 'consumer1' as consumer
  union all select 'view', '', 'consumer2'
  union all select 'signup', '', 'consumer2'
  union all select '', 'p.*', 'consumer3'
  union all select '', '', 'connect'
  union all select 'error', 'cli', 'consumer3'
), topic_dim as (
  select 'click' as topic, 'web' as team, 'gold' as tier
  union all select 'view', 'web', 'silver'
  union all select 'purchase', 'sales', 'gold'
  union all select 'signup', 'growth', 'bronze'
), topic_requests as (
  select 'name_space-' || t as topic, want_parts
  from (select 'click' as t, 4 as want_parts union all select 'view', 8 union all select 'refund', 4 union all select 'audit', 2) r
), topic_catalog as (
  select topic, count(distinct part) as parts,
         case when topic = 'name_space-error' then 'UNKNOWN_TOPIC_OR_PARTITION' end as err
  from record_log
  group by topic
), admin_responses as (
  select topic,
         case k % 4 when 0 then 'create' when 1 then 'grow' when 2 then 'alter' else 'delete' end as operation,
         case ((k - k % 4) / 4) % 5 when 1 then 'TOPIC_ALREADY_EXISTS' when 2 then 'INVALID_REQUEST'
              when 3 then 'UNKNOWN_TOPIC_OR_PARTITION' when 4 then 'POLICY_VIOLATION' end as err
  from record_log
), admin_outcomes as (
  select topic, operation, err,
         case when err is null then 'success'
              when operation = 'create' and err = 'TOPIC_ALREADY_EXISTS' then 'ignored'
              when operation = 'grow' and err = 'INVALID_REQUEST' then 'ignored'
              when operation = 'delete' and err = 'UNKNOWN_TOPIC_OR_PARTITION' then 'ignored'
              else 'failure' end as outcome
  from admin_responses
), bare_and_foreign as (
  select case when k < 50 then topic else 'other-' || substr(topic, 12) end as topic, event_id
  from record_log
), lag_state as (
  select c.grp, substr(c.topic, 12) as topic, c.part, coalesce(m.client_id, 'nil') as client_id,
         greatest(case when c.committed >= 0 then o.end_off - c.committed else o.end_off - o.start_off end, 0) as lag,
         coalesce(case when c.grp = 'consumer2' and c.part = 0 then 'UNKNOWN_TOPIC_OR_PARTITION' end,
                  o.start_err, o.end_err) as err
  from committed_offsets c
  join partition_offsets o on o.topic = c.topic and o.part = c.part
  left join members m on m.grp = c.grp and m.topic = c.topic and m.part = c.part
  where exists (
    select 1 from monitor w
    where w.consumer = c.grp
      and ((w.regex = '' and w.topic = substr(c.topic, 12))
           or (w.regex <> '' and regexp_matches(substr(c.topic, 12), w.regex))))
), line_log as (
  select 'name_space-' || l_returnflag || l_linestatus as topic,
         cast(l_orderkey % 8 as int) as part,
         cast(row_number() over (partition by l_returnflag || l_linestatus, l_orderkey % 8
              order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 as bigint) as roff,
         cast(l_orderkey as varchar(20)) as rkey,
         l_partkey || ':' || l_suppkey || ':' || l_linenumber as rvalue,
         epoch_us(l_shipdate) as ts_us,
         cast(trunc(l_quantity) as int) as k
  from lineitem
), line_polls as (
  select *, cast((roff - roff % 500) / 500 as bigint) as poll_id, k >= 10 as ok
  from line_log
), message_delay as (
  select topic, part, roff, max(ts_us) over (partition by topic, part, poll_id) - ts_us as delay_us
  from poll_log
)
"""


def bare(topic: str = "topic") -> str:
    """SQL for a topic without its namespace (``name_space-`` has 11 characters)."""
    return f"case when starts_with({topic}, 'name_space-') then substr({topic}, 12) else {topic} end"


CODEC = (
    "case codec_id when 0 then 'none' when 1 then 'gzip' when 2 then 'snappy'"
    " when 3 then 'lz4' when 4 then 'zstd' else 'unknown' end"
)
PRODUCE_REASON = (
    "case when err = 'deadline_exceeded' then 'timeout' when err = 'canceled' then 'canceled'"
    " when is_broker_err then err else 'unknown' end"
)
CONNECT_REASON = (
    "case when err = 'canceled' then 'canceled' when err = 'deadline_exceeded' then 'timeout' else 'unknown' end"
)


def histogram_sql(source: str, attrs: Sequence[str], value: str, bounds: Sequence[float]) -> str:
    """One row per attribute set and bucket, empty buckets included."""
    limits = ", ".join(str(int(b * 1_000_000 + 1e-6)) for b in bounds)
    keys = "".join(f"{a}, " for a in attrs)
    same = "".join(f" and c.{a} = t.{a}" for a in attrs)
    outer = "".join(f"t.{a}, " for a in attrs)
    group = f"group by {', '.join(attrs)}" if attrs else ""
    return f"""
select {outer}t.count, t.sum_us, t.min_us, t.max_us, b.bucket, coalesce(c.n, 0) as bucket_count
from (select {keys}count(*) as count, cast(sum({value}) as bigint) as sum_us,
             min({value}) as min_us, max({value}) as max_us
      from ({source}) s {group}) t
cross join (select cast(range as int) as bucket from range({len(bounds) + 1})) b
left join (select {keys}cast(len(list_filter([{limits}], lambda x: x < {value})) as int) as bucket, count(*) as n
           from ({source}) s group by all) c on c.bucket = b.bucket{same}
"""
