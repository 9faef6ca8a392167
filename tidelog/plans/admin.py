"""Queries over group and topic metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators import catalog, lag
from tidelog.functions.naming import strip_namespace
from tidelog.plans.registry import query
from tidelog.plans.sql import bare
from tidelog.plans.views import NAMESPACE, Inputs

CONFIGS = {"retention.ms": "123", "cleanup.policy": "compact,delete", "max.message.bytes": "1024"}


def _state(i: Inputs) -> DataFrame:
    # One group's commits in one partition number could not be read.
    broken = F.when(F.expr("grp = 'consumer2' and part = 0"), "UNKNOWN_TOPIC_OR_PARTITION")
    return lag.lag_state(
        i.committed_offsets.withColumn("commit_err", broken), i.members, i.partition_offsets, i.monitor, NAMESPACE
    )


@query(
    "consumer_group_lag",
    "select grp, topic, part, client_id, lag from lag_state where err is null",
)
def consumer_group_lag(i: Inputs) -> DataFrame:
    return lag.consumer_group_lag(_state(i))


@query(
    "monitored_topics",
    f"""select distinct c.grp, {bare('c.topic')} as topic from committed_offsets c
        where exists (select 1 from monitor w where w.consumer = c.grp
          and ((w.regex = '' and w.topic = {bare('c.topic')})
               or (w.regex <> '' and regexp_matches({bare('c.topic')}, w.regex))))""",
)
def monitored_topics(i: Inputs) -> DataFrame:
    pairs = i.committed_offsets.withColumn("topic", strip_namespace(F.col("topic"), NAMESPACE))
    return lag.monitored_topics(pairs, i.monitor)


@query("lag_member", "select grp, topic, part, client_id from lag_state where err is null")
def lag_member(i: Inputs) -> DataFrame:
    return lag.consumer_group_lag(_state(i)).drop("lag")


@query(
    "lag_errors",
    """select grp, topic, part, err,
              case when err = 'UNKNOWN_TOPIC_OR_PARTITION' then 'debug' else 'warn' end as severity
       from lag_state where err is not null""",
)
def lag_errors(i: Inputs) -> DataFrame:
    return lag.lag_errors(_state(i))


@query(
    "consumer_group_assignment",
    """select grp, topic, client_id, count(*) as partitions from lag_state where err is null
       group by grp, topic, client_id""",
)
def consumer_group_assignment(i: Inputs) -> DataFrame:
    return lag.consumer_group_assignment(_state(i))


@query(
    "monitored_groups",
    """select m.grp, count(c.part) as partitions
       from (select distinct consumer as grp from monitor) m
       left join committed_offsets c on c.grp = m.grp group by m.grp""",
)
def monitored_groups(i: Inputs) -> DataFrame:
    """With how many partitions each has a position in; ``connect`` has none."""
    counts = i.committed_offsets.groupBy("grp").agg(F.count(F.lit(1)).alias("partitions"))
    return lag.monitored_groups(i.monitor).join(counts, "grp", "left").na.fill(0, ["partitions"])


@query(
    "list_topics",
    """select topic, coalesce(err, '') as err from topic_catalog
       where starts_with(topic, 'name_space-')""",
)
def list_topics(i: Inputs) -> DataFrame:
    return catalog.list_topics(i.topic_catalog, f"{NAMESPACE}-").na.fill("", ["err"])


PLAN = """
select r.topic, r.want_parts, coalesce(c.parts, 0) as have_parts, c.topic is null as missing,
       c.topic is not null as existing, coalesce(c.parts < r.want_parts, false) as grow
from topic_requests r
left join (select * from topic_catalog where err is null or err <> 'UNKNOWN_TOPIC_OR_PARTITION') c on c.topic = r.topic
"""


@query("topic_plan", PLAN)
def topic_plan(i: Inputs) -> DataFrame:
    return catalog.topic_plan(i.topic_requests, i.topic_catalog)


@query("missing_topics", f"select topic from ({PLAN}) p where missing")
def missing_topics(i: Inputs) -> DataFrame:
    return catalog.missing_topics(i.topic_requests, i.topic_catalog)


@query(
    "alterable_configs",
    f"""select topic, name, value from ({PLAN}) p
        cross join (select 'retention.ms' as name, '123' as value union all select 'max.message.bytes', '1024') c
        where existing""",
)
def alterable_configs(i: Inputs) -> DataFrame:
    return catalog.alterable_configs(topic_plan(i), CONFIGS)


@query(
    "admin_outcomes",
    """select operation, coalesce(err, '') as err, outcome, count(*) as num from admin_outcomes
       group by operation, err, outcome""",
)
def admin_outcomes(i: Inputs) -> DataFrame:
    counts = i.admin_responses.groupBy("operation", "err").agg(F.count(F.lit(1)).alias("num"))
    return catalog.admin_outcomes(counts).na.fill("", ["err"])


@query(
    "topics_created",
    f"""select {bare()} as topic, outcome, count(*) as value from admin_outcomes
        where operation = 'create' and outcome <> 'ignored' group by 1, 2""",
)
def topics_created(i: Inputs) -> DataFrame:
    return catalog.topics_created(i.admin_responses, NAMESPACE)


@query(
    "topics_deleted",
    f"""select d.topic, d.outcome, d.value, coalesce(t.team, '') as team, coalesce(t.tier, '') as tier
        from (select {bare()} as topic, outcome, count(*) as value from admin_outcomes
              where operation = 'delete' and outcome <> 'ignored' group by 1, 2) d
        left join topic_dim t on t.topic = d.topic""",
)
def topics_deleted(i: Inputs) -> DataFrame:
    counted = catalog.topics_deleted(i.admin_responses, NAMESPACE, i.topic_dim)
    return counted.na.fill("", ["team", "tier"])


@query(
    "joined_errors",
    f"""select operation, string_agg(line, chr(10) order by line) as errors, count(*) as lines
        from (select distinct operation,
                     case operation when 'create' then 'failed to create topic'
                                    when 'grow' then 'failed to update partitions for topic'
                                    when 'alter' then 'failed to alter configuration for topic'
                                    else 'failed to delete topic' end
                     || ' "' || {bare()} || '": ' || err as line
              from admin_outcomes where outcome = 'failure') f
        group by operation""",
)
def joined_errors(i: Inputs) -> DataFrame:
    return catalog.joined_errors(i.admin_responses, NAMESPACE)
