"""A record log stored as a table.

The layout is ``<path>/log/topic=<t>/part=<p>/segment=<n>/*.parquet``, rows carrying the
offset ``roff`` that a broker would have given them, plus ``<path>/ends`` with one row per
partition and ``<path>/manifest`` with the offsets of each segment. A topic filter prunes
directories. A file holds one unbroken range of offsets of
one partition, so an offset range prunes files, and the files' times follow their offsets,
which is the order in which a stream takes them.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.joins import BROADCAST_ROWS, bounded
from tidelog.functions.labels import CODECS
from tidelog.sources.file_batches import files_of_batch
from tidelog.sources.shared import merging_what_is_kept

MANIFEST = "topic string, part int, segment int, first bigint, next bigint"
#: How much of a log a micro-batch takes by default.
BYTES_PER_TRIGGER = 256 << 20
# Codecs the Parquet writer knows under another name.
_PARQUET_NAMES = {"none": "uncompressed", "lz4": "lz4_raw"}


def choose_codec(preferred: Sequence[str] | str = (), supported: Sequence[str] = CODECS) -> str:
    """First codec of an ordered preference list that the sink supports.

    The list may be a comma separated string. Every unknown name is reported, in order.
    With no preference: snappy if supported, else none.
    """
    names = [n for n in preferred.split(",") if n] if isinstance(preferred, str) else list(preferred)
    unknown = [name for name in names if name not in CODECS]
    if unknown:
        raise ValueError("\n".join(f'unknown codec "{name}"' for name in unknown))
    for name in names or ("snappy", "none"):
        if name in supported:
            return name
    raise ValueError(f"no supported codec in {names}")


@dataclass(frozen=True)
class LogTable:
    """A stored log. ``partitions`` is how many (topic, part) pairs it has."""

    path: str
    schema: T.StructType
    partitions: int

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.schema(self.schema).parquet(f"{self.path}/log")
        return rows.select(*self.schema.names)

    def read_segments(self, spark: SparkSession) -> DataFrame:
        """As ``read``, with the directory ``segment`` that a row is in, for joins with the manifest."""
        full = T.StructType([*self.schema.fields, T.StructField("segment", T.IntegerType())])
        return spark.read.schema(full).parquet(f"{self.path}/log").select(*full.names)

    def manifest(self, spark: SparkSession) -> DataFrame:
        """``topic, part, segment, first, next``: which offsets each segment holds, without a log scan."""
        return spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def ranges_of_batch(self, spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
        """``topic, part, first, next`` of the segments that a micro-batch of ``read_stream`` takes.

        From the names of its files and the manifest; no record is read. A segment is one file,
        unless Spark was told to write no more than so many rows to each; then use no claims.
        """

        def plain(name: Column) -> Column:  # escaped once in the folder's name, and again as a URI
            for _ in range(2):
                name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
            return name

        pattern = "/topic=([^/]*)/part=(\\d+)/segment=(\\d+)/"
        value = lambda n: F.regexp_extract("path", pattern, n)
        taken = files_of_batch(spark, checkpoint, batch_id).select(
            plain(value(1)).alias("topic"), value(2).cast("int").alias("part"), value(3).cast("int").alias("segment")
        )
        found = self.manifest(spark).join(taken, ["topic", "part", "segment"], "left_semi")
        return found.select("topic", "part", "first", "next")

    def read_stream(self, spark: SparkSession, bytes_per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
        """The log as a file stream; a micro-batch takes ``bytes_per_trigger`` of files, one at least."""
        reader = spark.readStream.schema(self.schema).option("maxBytesPerTrigger", bytes_per_trigger)
        return reader.parquet(f"{self.path}/log").select(*self.schema.names)

    def ends(self, spark: SparkSession) -> DataFrame:
        """``topic, part, end_off``: the next offset of each partition, without a log scan."""
        return read_ends(spark, f"{self.path}/ends")


def read_ends(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("topic string, part int, end_off bigint").parquet(path)


def write_ends(records: DataFrame, path: str) -> DataFrame:
    """Where each partition of a log of ``records`` ends, without building the log.

    Offsets are dense, so that is the number of its records.
    """
    counts = records.groupBy("topic", "part").agg(F.count(F.lit(1)).alias("end_off"))
    counts.write.parquet(path)
    return read_ends(records.sparkSession, path)


def write_log(
    records: DataFrame,
    path: str,
    order_by: Sequence[str],
    codec: str = "snappy",
    segments: int | None = None,
) -> LogTable:
    """Give every record its offset and store the log.

    ``records`` has ``topic``, ``part`` and the columns of ``order_by``, which must order
    the rows of a partition without ties. Offsets are 0, 1, 2, ... in that order.

    Ranking a partition in one window would put a hot partition into one task. So rows are
    range partitioned over (topic, part, order), which cuts a hot partition into many
    segments; a row's offset is its position in the segment plus the sizes of the segments
    before it. The segmented rows are kept on the executors' disks to be counted and then
    written, once. Both steps see the same cuts: they belong to the plan that is kept, and
    what is lost with an executor is made again from it, in the same order.

    ``segments`` is how many cuts to make; by default the session's shuffle partitions,
    merged where they are small.
    """
    spark = records.sparkSession
    where = ["topic", "part"]
    compression = _PARQUET_NAMES.get(codec, codec)
    segments_at = f"{path}/segments"
    cuts = [segments] if segments else []
    staged = (
        records.repartitionByRange(*cuts, *where, *order_by)
        .withColumn("_seg", F.spark_partition_id())
        .sortWithinPartitions(*where, "_seg", *order_by)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    with merging_what_is_kept(spark):
        staged.persist(StorageLevel.DISK_ONLY)

    earlier = (
        Window.partitionBy(*where)
        .orderBy("_seg")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    (
        staged.groupBy(*where, "_seg")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.sum("_n").over(earlier) - F.col("_n") - F.col("_first"))
        .write.parquet(segments_at)
    )
    counted = spark.read.schema(
        "topic string, part int, _seg int, _first bigint, _n bigint, _shift bigint"
    ).parquet(segments_at)
    first = F.col("_first") + F.col("_shift")
    manifest = counted.select(*where, F.col("_seg").alias("segment"), first.alias("first"), (first + F.col("_n")).alias("next"))
    manifest.coalesce(1).write.parquet(f"{path}/manifest")
    ends = counted.groupBy(*where).agg(F.sum("_n").alias("end_off"), F.count("_seg").alias("_segments"))
    ends.select(*where, "end_off").write.parquet(f"{path}/ends")
    sizes = ends.agg(F.count(F.lit(1)), F.coalesce(F.sum("_segments"), F.lit(0))).first()

    shifts = bounded(counted.select(*where, "_seg", "_shift"), sizes[1])
    logged = (
        staged.join(shifts, [*where, "_seg"])
        .withColumn("roff", F.col("_row") + F.col("_shift"))
        .withColumnRenamed("_seg", "segment")
        .drop("_row", "_shift")
    )
    # Tasks may read several segments; a directory each keeps their offsets in files apart. The kept rows are
    # sorted by (topic, part, segment, offset) and a broadcast leaves them so; sorted again, they would only spill.
    if sizes[1] > BROADCAST_ROWS:
        logged = logged.sortWithinPartitions(*where, "segment", "roff")
    logged.write.option("compression", compression).partitionBy(*where, "segment").parquet(f"{path}/log")
    staged.unpersist()
    _time_in_order(spark, f"{path}/log")
    fields = {f.name: f for f in logged.drop("segment").schema.fields}
    stored = [f for name, f in fields.items() if name not in where] + [fields[c] for c in where]
    return LogTable(path, T.StructType(stored), sizes[0])


def _time_in_order(spark: SparkSession, path: str) -> None:
    """Give the files of a log times in the order of their segments, a millisecond apart.

    File streams take files by time. On stores that cannot set times the order of a stream
    is the order of writing; commits count unbroken ranges only, so nothing is lost there.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found, files = fs.listFiles(folder, True), []
    while found.hasNext():
        file = found.next().getPath()
        match = re.search(r"/segment=(\d+)/[^/]*part-(\d+)[^/]*$", file.toString())
        if match:
            files.append((int(match[1]), int(match[2]), file.toString(), file))
    now = int(time.time() * 1000) - len(files)
    for nth, (*_, file) in enumerate(sorted(files, key=lambda f: f[:3])):
        fs.setTimes(file, now + nth, -1)
