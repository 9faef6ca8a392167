"""Log-shaped inputs derived from the ``events`` table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.naming import strip_namespace
from tidelog.sources.envelope import to_envelope
from tidelog.sources.log_table import LogTable, read_ends, write_ends, write_log
from tidelog.sources.scan import with_polls
from tidelog.sources.shared import new_folder, version_of

NAMESPACE = "name_space"
PARTS = 4
MAX_POLL = 50
FAILS_BELOW = 10
GROUPS = {"consumer1": 1, "consumer2": 2, "consumer3": 3, "consumer4": 4}

# What a session has stored or looked up, by application, folder and kind: the table's version then, and what was built.
_stored: dict = {}


def micros(spark: SparkSession, ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone.

    In a UTC session a cast does it; elsewhere the slower way by subtraction is needed.
    """
    if spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "GMT"):
        return F.unix_micros(F.col(ts).cast("timestamp"))
    return F.expr(
        f"cast(cast(cast({ts} - timestamp_ntz'1970-01-01 00:00:00' as interval second)"
        " as decimal(18,6)) * 1000000 as bigint)"
    )


class Inputs:
    """The views of one data folder.

    Offsets are assigned once per session, folder and version of the table: the log is written to the shared
    folder as a table, as a broker would keep it, and queries that need offsets read that
    table. Those that need only where partitions end read a table of counts, and those that
    need neither read the routed events.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._versions: dict[str, tuple] = {}  # of the tables, when this query first looked at them

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once per session and version of the table."""
        path = self._path(name)
        schema = self._once(f"{name} schema", name, lambda: self.spark.read.parquet(path).schema)
        return self.spark.read.schema(schema).parquet(path)

    def _path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def _once(self, kind: str, table: str, build):
        """What ``build`` gives for a table, until the table changes."""
        if table not in self._versions:
            self._versions[table] = version_of(self.spark, self._path(table))
        key = (self.spark.sparkContext.applicationId, self.sf_dir, kind)
        if key not in _stored or _stored[key][0] != self._versions[table]:
            _stored[key] = self._versions[table], build()
        return _stored[key][1]

    @property
    def event_records(self) -> DataFrame:
        """One bare-topic record per event, before it is routed and numbered."""
        return self.table("events").select(
            F.col("event_type").alias("topic"),
            F.col("user_id").cast("string").alias("rkey"),
            F.col("props").alias("rvalue"),
            micros(self.spark, "ts").alias("ts_us"),
            F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"),
            "event_id",
        )

    @cached_property
    def routed(self) -> DataFrame:
        """The records with wire topic and partition, not yet numbered."""
        part = F.col("rkey").cast("bigint") % PARTS
        return to_envelope(self.event_records, NAMESPACE, PARTS, partitioner=part).drop("headers")

    @cached_property
    def log_table(self) -> LogTable:
        def build() -> LogTable:
            return write_log(self.routed, new_folder(self.spark, "events"), ["ts_us", "event_id"])

        return self._once("events", "events", build)

    @cached_property
    def line_table(self) -> LogTable:
        """The larger log, out of ``lineitem``."""

        def build() -> LogTable:
            order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
            records = self.table("lineitem").select(
                F.concat("l_returnflag", "l_linestatus").alias("topic"),
                F.col("l_orderkey").cast("string").alias("rkey"),
                F.concat_ws(":", "l_partkey", "l_suppkey", "l_linenumber").alias("rvalue"),
                micros(self.spark, "l_shipdate").alias("ts_us"),
                F.col("l_quantity").cast("int").alias("k"),
                *order,
            )
            envelope = to_envelope(records, NAMESPACE, 8, partitioner=F.col("l_orderkey") % 8)
            return write_log(
                envelope.drop("headers", "l_shipdate"),
                new_folder(self.spark, "lines"),
                ["ts_us", *order[1:]],
            )

        return self._once("lines", "lineitem", build)

    @cached_property
    def record_log(self) -> DataFrame:
        return self.log_table.read(self.spark)

    @property
    def poll_log(self) -> DataFrame:
        return with_polls(self.record_log, MAX_POLL).withColumn(
            "ok", F.coalesce(F.col("k") >= FAILS_BELOW, F.lit(False))
        )

    @property
    def batch_log(self) -> DataFrame:
        raw = F.sum(F.length("rvalue"))
        sums = self.poll_log.groupBy("topic", "part", "poll_id").agg(
            F.count(F.lit(1)).alias("num_records"),
            raw.alias("uncompressed_bytes"),
            F.max("ts_us").alias("read_us"),
        )
        codec = ((F.col("poll_id") + F.col("part")) % 6).cast("int")
        saved = F.when(codec == 0, F.lit(0)).otherwise(2 * F.col("num_records"))
        return sums.withColumn("codec_id", codec).withColumn(
            "compressed_bytes", F.col("uncompressed_bytes") - saved
        )

    @property
    def produce_log(self) -> DataFrame:
        """All records with ``err`` set on the failed ones."""
        k4 = F.col("k") % 4
        err = (
            F.when(k4 == 0, "deadline_exceeded")
            .when(k4 == 1, "canceled")
            .when(k4 == 2, "UNKNOWN_TOPIC_OR_PARTITION")
            .otherwise("boom")
        )
        return self.poll_log.select(
            "topic",
            "part",
            "roff",
            "rkey",
            "k",
            F.when(~F.col("ok"), err).alias("err"),
            (k4 == 2).alias("is_broker_err"),
        )

    @property
    def produce_failure_log(self) -> DataFrame:
        return self.produce_log.where(F.col("err").isNotNull())

    @property
    def broker_event_log(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "click", "write")
            .when(F.col("event_type") == "view", "read")
            .when(F.col("event_type") == "error", "connect")
            .when(F.col("event_type") == "signup", "throttle")
            .otherwise("disconnect")
        )
        k = F.col("k")
        operation = (
            F.when(k % 4 == 0, "ApiVersions")
            .when(k % 4 == 1, "Metadata")
            .when(k % 4 == 2, "Produce")
            .otherwise("Fetch")
        )
        err = F.when(
            k < FAILS_BELOW,
            F.when(k % 3 == 0, "canceled").when(k % 3 == 1, "deadline_exceeded").otherwise("boom"),
        )
        return (
            self.table("events")
            .withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).try_cast("int"))
            .select(
                "event_id",
                kind.alias("kind"),
                operation.alias("operation"),
                (k * 100).cast("bigint").alias("nbytes"),
                (k * 1000).cast("bigint").alias("wait_us"),
                (F.col("event_id") % 1000).alias("io_us"),
                err.alias("err"),
            )
        )

    @cached_property
    def ends(self) -> DataFrame:
        """``topic, part, end_off``, counted once per session and version of the table."""

        def build() -> str:
            path = new_folder(self.spark, "ends")
            write_ends(self.routed, path)
            return path

        return read_ends(self.spark, self._once("ends", "events", build))

    @property
    def partition_offsets(self) -> DataFrame:
        at = lambda topic, part: (F.col("topic") == f"{NAMESPACE}-{topic}") & (F.col("part") == part)
        return self.ends.select(
            "topic",
            "part",
            F.expr("end_off div 10").alias("start_off"),
            "end_off",
            F.when(at("view", 1), "OFFSET_OUT_OF_RANGE").alias("start_err"),
            F.when(at("signup", 2), "UNKNOWN_TOPIC_OR_PARTITION").alias("end_err"),
        )

    @property
    def committed_offsets(self) -> DataFrame:
        groups = F.array(*[F.struct(F.lit(g).alias("grp"), F.lit(n).alias("n")) for g, n in GROUPS.items()])
        committed = F.when((F.col("n") == 3) & (F.col("part") == 0), F.lit(-1).cast("bigint")).otherwise(
            F.expr("end_off * n div 4")
        )
        return self.ends.select("topic", "part", "end_off", F.inline(groups)).select(
            "grp", "topic", "part", committed.alias("committed")
        )

    @property
    def members(self) -> DataFrame:
        client = F.concat(F.lit("client-"), (F.col("part") % 2).cast("string"))
        return self.committed_offsets.where(F.col("part") != 3).select(
            "grp", "topic", "part", client.alias("client_id")
        )

    def _rows(self, rows: list[tuple], columns: str) -> DataFrame:
        """A literal table; unlike ``createDataFrame`` its size is known to the planner."""
        values = ", ".join(str(row).replace("None", "null") for row in rows)
        return self.spark.sql(f"select * from values {values} as t({columns})")

    @property
    def monitor(self) -> DataFrame:
        return self._rows(
            [
                ("click", "", "consumer1"),
                ("view", "", "consumer2"),
                ("signup", "", "consumer2"),
                ("", "p.*", "consumer3"),
                ("", "", "connect"),
                ("error", "cli", "consumer3"),
            ],
            "topic, regex, consumer",
        )

    @property
    def topic_dim(self) -> DataFrame:
        return self._rows(
            [
                ("click", "web", "gold"),
                ("view", "web", "silver"),
                ("purchase", "sales", "gold"),
                ("signup", "growth", "bronze"),
            ],
            "topic, team, tier",
        )

    @property
    def topic_requests(self) -> DataFrame:
        wanted = [("click", 4), ("view", 8), ("refund", 4), ("audit", 2)]
        return self._rows(
            [(f"{NAMESPACE}-{t}", n) for t, n in wanted], "topic, want_parts"
        )

    @property
    def topic_catalog(self) -> DataFrame:
        err = F.when(F.col("topic") == f"{NAMESPACE}-error", "UNKNOWN_TOPIC_OR_PARTITION")
        return (
            self.ends.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("parts"))
            .withColumn("err", err)
        )

    @property
    def admin_responses(self) -> DataFrame:
        """One administrative response per record: operation and error follow ``k``.

        They repeat every 20 values of ``k``, so they come from a table of 20 rows. Filters
        on them then apply to that table instead of parsing ``k`` once more for each branch.
        """
        operations = ("create", "grow", "alter", "delete")
        errors = (
            None,
            "TOPIC_ALREADY_EXISTS",
            "INVALID_REQUEST",
            "UNKNOWN_TOPIC_OR_PARTITION",
            "POLICY_VIOLATION",
        )
        kinds = self._rows(
            [(n, operations[n % 4], errors[n // 4]) for n in range(20)], "id, operation, err"
        )
        records = self.routed.select("topic", (F.col("k") % 20).alias("id"))
        return records.join(kinds, "id").select("topic", "operation", "err")

    @property
    def bare_and_foreign(self) -> DataFrame:
        """Topics inside and outside the namespace."""
        bare = strip_namespace(F.col("topic"), NAMESPACE)
        foreign = F.concat(F.lit("other-"), bare)
        return self.routed.select(
            F.when(F.col("k") < 50, F.col("topic")).otherwise(foreign).alias("topic"), "event_id"
        )
